"""Namespaces and tables that a load writes.

Tables are external parquet tables.  A reload writes a complete new version in
a folder of its own and then moves the table's location to it, which is one
metadata change: readers see the old rows or the new ones, and a lost job
leaves the table as it was.  Partitioned tables, tables with versions and those
that runs append to are kept by their loads, see `versioned`: there, too, one
change shows all that a load did.
"""

from __future__ import annotations

import datetime
import urllib.parse
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from starload.local import small_frame
from starload.scratch import fresh_path, list_folders, remove
from starload.sources.versioned import CLOSED, OPEN, VersionedTable
from starload.spec import IS_CURRENT, TableSpec, comment

# The namespaces of a load, the only ones that `reset` touches.
RAW, STAGING, ANALYTICS = "raw", "staging", "analytics"
NAMESPACES = (RAW, STAGING, ANALYTICS)


class Merger(Protocol):
    """What merges rows into a table where the table's own catalog can."""

    def can_merge(self, table: str) -> bool: ...

    def merge(self, table: str, rows: DataFrame, on: Sequence[str]) -> int: ...


class CatalogMerger:
    """MERGE INTO by `DataFrame.mergeInto`, for tables of the providers given, whose catalogs support row-level changes."""

    def __init__(self, spark: SparkSession, providers: Sequence[str] = ("delta", "iceberg", "hudi")) -> None:
        self.spark, self.providers = spark, frozenset(providers)

    def can_merge(self, table: str) -> bool:
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Provider'").first()
        return described is not None and described["data_type"].lower() in self.providers

    def merge(self, table: str, rows: DataFrame, on: Sequence[str]) -> int:
        target = table.rpartition(".")[2]
        seen, rows = _observed(rows)
        same = reduce(Column.__and__, [F.col(f"{target}.`{c}`") == F.col(f"_merged.`{c}`") for c in on])
        (rows.alias("_merged").mergeInto(table, same).whenMatched().updateAll().whenNotMatched().insertAll().merge())
        return seen.get["rows"]


class Warehouse:
    """The namespaces of one project under one root folder.

    `prefix` is put before the namespace names to get database names, so that
    several projects can live in one catalog.  `merger` merges into tables that
    it says it can; without one, rows are merged by writing files again.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, prefix: str = "", merger: Merger | None = None) -> None:
        self.spark = spark
        self.merger = merger
        self._reported: set[tuple[str, str]] = set()
        self.root = (root or fresh_path(spark, "warehouse", owned=True)).rstrip("/")
        self.prefix = prefix

    # --- names and definitions

    def name(self, table: TableSpec | str) -> str:
        full = table.full_name if isinstance(table, TableSpec) else table
        namespace, _, name = full.partition(".")
        return f"`{self.prefix}{namespace}`.`{name}`"

    def create_namespaces(self, namespaces: Sequence[str] = NAMESPACES) -> None:
        for n in namespaces:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.prefix}{n}` LOCATION '{self.root}/{n}'")

    def create_table(self, spec: TableSpec, *, by_loads: bool = False, versions: bool = False) -> None:
        """Create the table if it is not there; VARCHAR lengths are enforced on every insert.

        Partitioned tables, with `by_loads` others too, are kept by their loads;
        `versions` says that the table has versions.
        """
        if self.exists(spec):
            return
        if spec.partition_by or by_loads or versions:
            VersionedTable(self, spec).create(versions=versions)
        else:
            self.create_files(self.name(spec), spec, self._new_path(spec))

    def attach(self, name: str, path: str | None = None, *, spec: TableSpec | None = None,
               format: str = "parquet", **options: str) -> None:
        """Make data that is already there a table, without copying it.

        Text formats need a spec for their columns and types.  A table of another
        database is attached with format='jdbc', no path, and the options of
        `readers.read_jdbc`.
        """
        columns = f"({', '.join(c.ddl for c in spec.columns)})" if spec else ""
        given = ", ".join(f"{_quoted(k)} {_quoted(v)}" for k, v in options.items())
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(name)} {columns} USING {format}"
                       + (f" OPTIONS ({given})" if given else "")
                       + (f" LOCATION {_quoted(path)}" if path else ""))

    def exists(self, table: TableSpec | str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def table(self, table: TableSpec | str) -> DataFrame:
        return self.spark.table(self.name(table))

    def find(self, table: TableSpec | str) -> DataFrame | None:
        """The table, or None if there is none of that name."""
        return self.table(table) if self.exists(table) else None

    # --- writing

    def replace(self, spec: TableSpec, df: DataFrame) -> int:
        """Make df the content of the table; returns its number of rows.

        df may read the table itself.
        """
        self.create_table(spec)
        if kept := self.versioned(spec):
            return kept.write(df, everything=True)
        staged = f"`{self.prefix}{spec.namespace}`.`{spec.name}__{uuid.uuid4().hex}`"
        path = self._new_path(spec)
        self.create_files(staged, spec, path)
        rows = self.insert(staged, df, spec)
        self.spark.sql(f"ALTER TABLE {self.name(spec)} SET LOCATION '{path}'")
        self.spark.sql(f"DROP TABLE {staged}")
        return rows

    def append(self, spec: TableSpec, df: DataFrame, run: str | None = None) -> int:
        """Add df to the table; returns the number of rows added.

        In a table kept by loads, the rows of a `run` take the place of those that
        the same run added before, so a run can be repeated.
        """
        self.create_table(spec)
        if kept := self.versioned(spec):
            return kept.write(df, run=run)
        return self.insert(self.name(spec), df, spec)

    def replace_partitions(self, spec: TableSpec, df: DataFrame, touched: DataFrame) -> int:
        """Make df the content of the `touched` partitions and leave all others alone.

        `touched` has the partition columns, of which as many rows come to the driver as
        there are such partitions.  df may read the table itself, and has rows of
        touched partitions or of new ones only.
        """
        self.create_table(spec)
        gone = touched.select(*spec.partition_by).distinct().collect()
        return self.versioned(spec).write(df, replaced=[r.asDict() for r in gone])

    def merge(self, spec: TableSpec, rows: DataFrame, on: Sequence[str], touched: DataFrame | None = None) -> int:
        """Each of `rows` takes the place of the target's row with the same `on` values, or is added.

        `rows` is unique on `on`, never NULL there, and is read several times.  A catalog that can merge
        does it; otherwise the rows that stay are written again beside the new
        ones: of a table with versions those that are open (what has ended is
        final), of a partitioned one those of the partitions `touched` (found by
        `on` if not given), of others all.  Returns the number of rows written.
        """
        self.create_table(spec)
        if self.merger is not None and self.merger.can_merge(self.name(spec)):
            return self.merger.merge(self.name(spec), rows, on)
        kept = self.versioned(spec)
        if kept is None:
            return self.replace(spec, _others(self.table(spec), rows, on).unionByName(rows))
        if kept.has_versions():
            stay = _others(kept.rows(open_only=True), rows, on)
            return kept.write(stay.unionByName(rows), replaced=[{CLOSED: OPEN}])
        if not spec.partition_by:
            return kept.write(_others(self.table(spec), rows, on).unionByName(rows), everything=True)
        target, parts = self.table(spec), list(spec.partition_by)
        if touched is None:
            found = target.join(rows.select(*on), list(on), "left_semi").select(*parts)
            touched = rows.select(*parts).unionByName(found)
        # As many rows as touched partitions; they prune the read of the target.
        gone = touched.select(*parts).distinct()
        values = [r.asDict() for r in gone.collect()]
        wanted = F.broadcast(small_frame(self.spark, [tuple(v.values()) for v in values], gone.schema))
        for p in parts:
            in_list = sorted({v[p] for v in values if v[p] is not None})
            target = target.where(F.col(p).isin(in_list) | F.col(p).isNull())
        affected = target.join(wanted, [target[p].eqNullSafe(wanted[p]) for p in parts], "left_semi")
        return kept.write(_others(affected, rows, on).unionByName(rows), replaced=values)

    def versioned(self, spec: TableSpec) -> VersionedTable | None:
        """The loads of a table that is kept by them."""
        found = VersionedTable(self, spec)
        return found if found.exists() else None

    def open_versions(self, spec: TableSpec) -> DataFrame:
        """The versions of a table with versions that are current, read without those that have ended."""
        kept = self.versioned(spec)
        return kept.rows(open_only=True) if kept and kept.has_versions() else self.table(spec).where(IS_CURRENT)

    def write_staging(self, name: str, df: DataFrame) -> int:
        """Materialise staged rows as they are; replaces an earlier staging table."""
        full = self.name(f"{STAGING}.{name}")
        self.spark.sql(f"DROP TABLE IF EXISTS {full}")
        seen, df = _observed(df)
        path = f"{self.root}/{STAGING}/{name}/{uuid.uuid4().hex}"
        df.write.option("path", path).saveAsTable(full)
        return seen.get["rows"]

    def append_report(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        """Append to a dated report table."""
        self._create_report(name, df.schema, partition_by)
        df.write.mode("append").partitionBy(*partition_by).saveAsTable(self.name(name))

    def report_of_run(self, name: str, df: DataFrame, partition: Mapping[str, str | int | datetime.date], *,
                      renew: bool = True) -> None:
        """Add rows to a report or log table in a partition that belongs to one run.

        `partition` has the partition columns with their values, which df does
        not have.  Every run writes to its own folder, so runs can write at the
        same moment; with `renew` a repeated run takes the place of its own rows.
        """
        types = {str: T.StringType(), int: T.IntegerType(), datetime.date: T.DateType()}
        folder = "/".join(f"{c}={urllib.parse.quote(str(v), safe='')}" for c, v in partition.items())
        folder = f"{self.root}/{name.replace('.', '/')}/{folder}"
        df.write.mode("overwrite" if renew else "append").parquet(folder)
        if (name, folder) in self._reported:  # by this object, so the table has the partition
            self.spark.catalog.refreshTable(self.name(name))
            return
        schema = T.StructType(df.schema.fields + [T.StructField(c, types[type(v)]) for c, v in partition.items()])
        self._create_report(name, schema, list(partition))
        values = ", ".join(f"`{c}` = {_quoted(v)}" for c, v in partition.items())
        self.spark.sql(f"ALTER TABLE {self.name(name)} ADD IF NOT EXISTS PARTITION ({values}) LOCATION {_quoted(folder)}")
        self.spark.catalog.refreshTable(self.name(name))
        self._reported.add((name, folder))

    def _create_report(self, name: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
        """Created on its own first, so that a run that finds it just created by another one adds its rows."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        path = f"{self.root}/{name.replace('.', '/')}"
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name(name)} ({columns}) USING parquet"
                       f" PARTITIONED BY ({_names(partition_by)}) LOCATION {_quoted(path)}")

    def vacuum(self, spec: TableSpec) -> int:
        """Delete the files of earlier versions of a table; returns the number of folders.

        Only for when nobody reads or writes those versions any more.
        """
        if kept := self.versioned(spec):
            return kept.vacuum()
        described = self.spark.sql(f"DESCRIBE FORMATTED {self.name(spec)}")
        used = described.where("col_name = 'Location'").first()["data_type"].rstrip("/").rpartition("/")[2]
        folders = list_folders(self.spark, f"{self.root}/{spec.namespace}/{spec.name}")
        old = [f for f in folders if f.rstrip("/").rpartition("/")[2] != used]
        remove(self.spark, old)
        return len(old)

    # --- reset

    def truncate(self, spec: TableSpec) -> None:
        """Empty a table by moving it to an empty folder."""
        self.replace(spec, self.table(spec).where(F.lit(False)))

    def drop_staging(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(f'{STAGING}.{name}')}")

    def reset(self, namespaces: Sequence[str] = NAMESPACES) -> list[str]:
        """Drop and recreate namespaces; only those of a load, never another database."""
        unknown = sorted(set(namespaces) - set(NAMESPACES))
        if unknown:
            raise ValueError(f"refusing to reset namespace(s) that no load owns: {unknown}")
        self._reported.clear()
        for n in namespaces:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.prefix}{n}` CASCADE")
        self.create_namespaces(namespaces)
        return list(namespaces)

    # --- helpers

    def _new_path(self, spec: TableSpec) -> str:
        return f"{self.root}/{spec.namespace}/{spec.name}/{uuid.uuid4().hex}"

    def create_files(self, name: str, spec: TableSpec, path: str) -> None:
        columns = ", ".join(c.ddl for c in spec.columns)
        layout = ""
        if spec.partition_by:
            layout += f" PARTITIONED BY ({_names(spec.partition_by)})"
        if spec.bucket_by:
            keys = _names(spec.bucket_by)
            layout += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {spec.buckets} BUCKETS"
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet{layout} LOCATION '{path}'"
                       f"{comment(spec.description)}")

    def insert(self, name: str, df: DataFrame, spec: TableSpec) -> int:
        """Insert into a table that is laid out like `spec`, and perhaps has more partition columns."""
        df = df.select(*self.spark.table(name).columns)
        if spec.partition_by:
            # One writer per partition and file size, instead of every task writing every partition.
            df = df.hint("rebalance", *spec.partition_by)
        elif spec.bucket_by:
            # The hash of a shuffle is the hash of the buckets: one file per bucket.
            df = df.repartition(spec.buckets, *spec.bucket_by)
        elif CLOSED in df.columns:
            df = df.hint("rebalance", CLOSED)
        # Counted in the stage that writes, where a repeated task is not counted twice.
        seen, df = _observed(df)
        df.write.insertInto(name)
        return seen.get["rows"]


def _others(target: DataFrame, rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows of target that none of `rows` takes the place of."""
    names = {c: f"_on_{c}" for c in on}
    marks = rows.select(*[F.col(c).alias(n) for c, n in names.items()])
    same = reduce(Column.__and__, [F.col(c) == F.col(n) for c, n in names.items()])
    return target.join(marks, same, "left_anti")


def _observed(df: DataFrame) -> tuple[Observation, DataFrame]:
    """df and the number of its rows, counted while it is written."""
    seen = Observation()
    return seen, df.observe(seen, F.count(F.lit(1)).alias("rows"))


def _names(columns: Sequence[str]) -> str:
    return ", ".join(f"`{c}`" for c in columns)


def _quoted(value: object) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"
