"""Surrogate keys: dense numbers, continued sequences."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starload.operators.skew import PLACE
from starload.scratch import materialise

POSITION = "_position"
# monotonically_increasing_id keeps the row in the lower 33 bits.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def position_rows(df: DataFrame, order_by: Sequence[str | Column], *, unique: bool = False) -> DataFrame:
    """df in ascending order, NULLs last, cut into ranges, with the range and place of each row.

    Rows equal in `order_by` follow the hash of their content, which keeps their
    order the same on every run, and rows that are equal altogether the place where they
    were written first, so that any number of them can be cut into several
    ranges.  That takes a write of df, left out if it is said to be `unique` on
    `order_by`.  The positions hold once the result has been written, and only
    then: read again from df, the ranges may be cut differently.
    """
    columns = df.columns
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by]
    if not unique:
        df = materialise(df.withColumn(PLACE, F.monotonically_increasing_id()), "places")
        order += [F.xxhash64(*columns), F.col(PLACE)]
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns)
    return ranges.withColumn(POSITION, F.monotonically_increasing_id())


def number_positions(written: DataFrame, name: str, after: Column | int = 0) -> DataFrame:
    """Replace the positions of written rows by the numbers `after`+1, `after`+2, ...

    Each range starts where the ranges before it end.
    """
    # One row per range comes to the driver, as many as there are shuffle partitions.
    sizes = {r["range"]: r["rows"] for r in
             written.groupBy(F.shiftright(POSITION, _ROW_BITS).alias("range"))
             .agg(F.count(F.lit(1)).alias("rows")).collect()}
    ends = itertools.accumulate((sizes.get(i, 0) for i in range(max(sizes, default=0))), initial=0)
    starts = F.split(F.lit(",".join(map(str, ends))), ",").cast("array<bigint>")
    base = F.lit(after) if isinstance(after, int) else after
    number = (base + F.get(starts, F.shiftright(POSITION, _ROW_BITS).cast("int"))
              + F.col(POSITION).bitwiseAND(F.lit(_ROW_MASK)) + 1)
    return written.withColumn(name, number.cast("bigint")).drop(POSITION)


def number_rows(df: DataFrame, order_by: Sequence[str | Column], name: str,
                after: Column | int = 0, *, unique: bool = False) -> DataFrame:
    """Number the rows in ascending order, NULLs last, starting with `after`+1.

    The result equals row_number() over the whole table, but no task sees the
    whole table.  `unique` is as in `position_rows`.
    """
    return number_positions(materialise(position_rows(df, order_by, unique=unique), "numbered"), name, after)


def highest(df: DataFrame, key: str) -> Column:
    """The largest key in use, 0 for an empty table, as a scalar subquery."""
    return df.agg(F.coalesce(F.max(key).cast("bigint"), F.lit(0))).scalar()
