"""Source tables, read with their declared columns and types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from starload.spec import TableSpec

CORRUPT, FILE = "_corrupt_record", "_file"


def typed(df: DataFrame, spec: TableSpec, *, try_cast: bool = False) -> DataFrame:
    """The declared columns of df, cast to their declared types.

    A value that cannot be cast fails the job, or becomes NULL with `try_cast`.
    """
    def cast(name: str, wanted: T.DataType) -> Column:
        return F.col(name).try_cast(wanted) if try_cast else F.col(name).cast(wanted)

    return df.select(*[cast(c.name, c.spark_type).alias(c.name) for c in spec.columns])


def _plain(spec: TableSpec) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.spark_type) for c in spec.columns])


def read_parquet(spark: SparkSession, path: str | list[str], spec: TableSpec | None = None) -> DataFrame:
    df = spark.read.parquet(*([path] if isinstance(path, str) else path))
    return typed(df, spec) if spec else df


def read_csv(spark: SparkSession, path: str | list[str], spec: TableSpec, *, header: bool = True,
             mode: str = "FAILFAST", **options: str) -> DataFrame:
    """Delimited text; a malformed row fails the job unless `mode` says otherwise."""
    return spark.read.schema(_plain(spec)).options(**options).csv(path, header=header, mode=mode)


def read_json(spark: SparkSession, path: str | list[str], spec: TableSpec, *,
              mode: str = "FAILFAST", **options: str) -> DataFrame:
    """One JSON object per line."""
    return spark.read.schema(_plain(spec)).options(**options).json(path, mode=mode)


def read_parsed(spark: SparkSession, path: str | list[str], spec: TableSpec, format: str, **options: str) -> DataFrame:
    """Records of text files (csv or json), also those that cannot be parsed.

    The declared columns, `_corrupt_record` (the whole text of a record that does
    not fit, else NULL) and `_file`.  To be written before it is split: what of a
    record is parsed depends on the columns that a query asks for.
    """
    schema = T.StructType(_plain(spec).fields + [T.StructField(CORRUPT, T.StringType())])
    df = spark.read.format(format).schema(schema).options(**options).load(
        path, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
    return df.select("*", F.col("_metadata.file_path").alias(FILE))


def rejected(parsed: DataFrame) -> DataFrame:
    """(file, text) of the records that do not fit."""
    return parsed.where(F.col(CORRUPT).isNotNull()).select(F.col(FILE).alias("file"), F.col(CORRUPT).alias("text"))


def accepted(parsed: DataFrame) -> DataFrame:
    """The records that fit, with the declared columns."""
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT, FILE)


def read_jdbc(spark: SparkSession, url: str, table: str, spec: TableSpec, *, partition_column: str,
              lower: str | int, upper: str | int, partitions: int, fetch_size: int = 10_000,
              **options: str) -> DataFrame:
    """A database table, read in ranges of one column so that no single task reads it all.

    Filters and the column list are sent to the database.  The driver jar must
    be on the classpath.
    """
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=table, partitionColumn=partition_column, lowerBound=str(lower),
        upperBound=str(upper), numPartitions=str(partitions), fetchsize=str(fetch_size), **options)
    return typed(reader.load(), spec)
