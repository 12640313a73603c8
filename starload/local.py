"""Small frames made from values on the driver."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema


def small_frame(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Rows as part of the plan itself: no job is needed to read them and their size is known."""
    types = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, types)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=types), schema)
