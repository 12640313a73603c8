"""Checks that need the mappings: loaded columns against their sources."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starload import spec as S
from starload.local import small_frame
from starload.operators import quality
from starload.operators.skew import HOT_ROWS
from starload.plans.build import Mapper, joined_sources

# Functions that turn text they cannot read into NULL.
PARSERS = ("udf_parse_date", "udf_parse_time")


def check_unparsed(spec: S.BuildSpec, sources: Mapping[str, DataFrame], mapper: Mapper | None = None) -> DataFrame:
    """`check_parsed` for the columns of a spec that read text: parser functions and try_cast."""
    mapper = mapper or Mapper(spec)
    parsed = {m.target_column: (mapper.source(m.source_columns[0], m.source_table), mapper.expression(m))
              for m in spec.columns if len(m.source_columns) == 1
              and (S.calls_any(m.udf, PARSERS) or m.transformation == S.DIRECT and m.try_cast)}
    source = joined_sources(spec, sources)
    if not parsed:
        return small_frame(source.sparkSession, [], quality.REPORT)
    return quality.check_parsed(spec.target.name, source, parsed)


# --- the part of the sources that a batch came from ---------------------------------


def not_before(staged: DataFrame, ts: str, name: str, kind: T.DataType) -> Column:
    """Whether a moment is not before the first one of a batch, or missing; a constant that reaches the scan."""
    instant = isinstance(staged.schema[ts].dataType, T.TimestampType)  # travels as a number, whatever the time zone
    first = staged.agg(F.unix_micros(F.min(ts)) if instant else F.min(ts).cast("string")).first()[0]
    if first is None:
        return F.col(name).isNull()
    least = F.timestamp_micros(F.lit(first)) if instant else F.lit(first).cast(staged.schema[ts].dataType)
    return (F.col(name) >= least.cast(kind)) | F.col(name).isNull()


def sources_of_batch(spec: S.BuildSpec, base_spec: S.TableSpec, sources: Mapping[str, DataFrame], staged: DataFrame,
                     mapper: Mapper) -> dict[str, DataFrame]:
    """The sources of a spec, of its base table only the rows that the staged batch came from.

    They are found by the keys of the batch with a semi-join before anything
    else moves: a small batch is broadcast, for a larger one Spark filters the scan
    with a Bloom filter of its own.  Of an append, whose batch begins at a
    moment, earlier partitions and row groups are not read at all.
    """
    found = choose_correlation(spec, base_spec)
    if found is None:
        return dict(sources)
    base = sources[spec.base_table]
    if "source_timestamp" in spec.load_options:
        ts, name = spec.load_options["timestamp"], spec.load_options["source_timestamp"]
        base = base.where(not_before(staged, ts, name, base.schema[name].dataType))
    marks = staged.select(*[F.col(c).alias(f"_batch_{i}") for i, c in enumerate(found.target_columns)])
    alias = spec.base_table.rpartition(".")[2]
    same = reduce(Column.__and__, [mapper.expression(m) == F.col(f"_batch_{i}") for i, m in enumerate(found.mappings)])
    return {**sources, spec.base_table: base.alias(alias).join(marks, same, "left_semi")}


# --- recomputation ---------------------------------------------------------------


@dataclass(frozen=True)
class Correlation:
    """How a target row finds its source row: target columns, and their values over the source."""

    target_columns: tuple[str, ...]
    mappings: tuple[S.ColumnMapping, ...]


def choose_correlation(spec: S.BuildSpec, source: S.TableSpec, *, across_runs: bool = False) -> Correlation | None:
    """Target columns that identify the source row, or None if there are none.

    Every source primary key column must arrive unchanged; failing that, one
    function of exactly the primary key columns is used.  Columns that merely
    happen to be unique never are.  A function that also reads the moment of the
    run finds the rows of its own run only, so it is not used `across_runs`.
    """
    pk = [c.lower() for c in source.primary_key]
    if not pk:
        return None

    def own(m: S.ColumnMapping) -> bool:
        return m.source_table in (None, spec.base_table)

    direct = {m.source_columns[0].lower(): m for m in reversed(spec.columns)
              if m.transformation == S.DIRECT and own(m)}
    if all(c in direct for c in pk):
        chosen = tuple(direct[c] for c in pk)
        return Correlation(tuple(m.target_column for m in chosen), chosen)
    for m in spec.columns:
        if (m.transformation == S.UDF and own(m) and not (across_runs and S.reads_run_timestamp(m.udf))
                and sorted(c.lower() for c in m.source_columns) == sorted(pk)):
            return Correlation((m.target_column,), (m,))
    return None


def check_recomputed(spec: S.BuildSpec, source_spec: S.TableSpec, target: DataFrame,
                     sources: Mapping[str, DataFrame], mapper: Mapper | None = None, *,
                     every_column: bool = False, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Derived columns computed again from the source and compared with what was loaded.

    Function columns are checked, with `every_column` also direct copies,
    expressions, defaults and UUIDs.  One join serves all columns.
    """
    table = spec.target.name
    mapper = mapper or Mapper(spec)
    kinds = (S.UDF, S.DIRECT, S.EXPRESSION, S.DEFAULT, S.UUID) if every_column else (S.UDF,)
    correlation = choose_correlation(spec, source_spec)
    used = correlation.target_columns if correlation else ()
    checked = [m for m in spec.columns if m.transformation in kinds
               and not (m.transformation == S.DIRECT and m.target_column in used)]
    if not checked:
        return small_frame(target.sparkSession, [], quality.REPORT)
    if correlation is None:
        return quality.constant_check(target.sparkSession, quality.ID_UDF.format(table=table),
                                      quality.WARN, quality.TEXT_NO_KEY, quality.DATA)
    counts = quality.recompute(
        target, joined_sources(spec, sources),
        {m.target_column: mapper.expression(m) for m in correlation.mappings},
        {m.target_column: mapper.expression(m) for m in checked}, hot_rows=hot_rows)
    entries = []
    for m in checked:
        n, rows = F.col(m.target_column), F.col("checked")
        function = m.udf.function if isinstance(m.udf, S.Call) else m.udf or m.transformation
        detail = F.when(rows == 0, quality.TEXT_UNCHECKED).otherwise(
            quality.text(quality.TEXT_MISMATCH, n=n, checked=rows, function=function))
        skipped = F.col("skipped")
        detail = F.when(skipped > 0, quality.text(quality.TEXT_SKIPPED, detail=detail, skipped=skipped)).otherwise(detail)
        status = (F.when(n > 0, quality.FAIL).when((rows == 0) | (skipped > 0), quality.WARN).otherwise(quality.PASS))
        check_id = quality.ID_UDF_COLUMN.format(table=table, column=m.target_column)
        entries.append(quality.entry(check_id, status, detail, n))
    return quality.unpivot(counts, entries)
