"""Joins and ordered scans that hold up when one key has a large share of all rows.

`hot_keys` finds the few keys that are too large for one task with one
pre-aggregated count.  `attach` salts exactly those in a lookup join, and
`keyed_scan` cuts exactly those into slices of their own order.  All other keys
take the ordinary plan, and no row is dropped on either way.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from starload.classic import broadcast_bytes, planned_bytes
from starload.local import small_frame
from starload.scratch import materialise

HOT_ROWS = 5_000_000
SAMPLED_ROWS = 10_000
SALT = "_salt"
FAN = "_fan"
SLICE = "_slice"
PLACE = "_place"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def planned_small(df: DataFrame) -> bool:
    """Whether Spark's own estimate allows to broadcast df."""
    return planned_bytes(df) <= broadcast_bytes(df.sparkSession)


def _equal(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [left[c] == right[c] for c in columns])


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equality that also holds between NULLs."""
    return reduce(Column.__and__, [left[c].eqNullSafe(right[c]) for c in columns])


def _fraction(hot_rows: int) -> float:
    return min(1.0, SAMPLED_ROWS / hot_rows)


def _hot(counts: DataFrame, keys: Sequence[str], found: Sequence, hot_rows: int) -> DataFrame | None:
    rows = [(*[r[k] for k in keys], math.ceil(r[FAN] / _fraction(hot_rows) / hot_rows)) for r in found]
    fields = [counts.schema[k] for k in keys]
    schema = T.StructType(fields + [T.StructField(FAN, T.IntegerType())])
    return small_frame(counts.sparkSession, rows, schema) if rows else None


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """Keys with more than about `hot_rows` rows and their fan-out, or None if there are none.

    At most as many keys come back as there are shuffle partitions.  Any key
    left out then has no more rows than an average partition, so the result is
    small enough to broadcast and complete enough to remove the skew.

    Sizes are estimated from a sample that holds SAMPLED_ROWS rows of a key of
    the limit size.  The answer only decides how work is cut into tasks; which
    rows end up in a result does not depend on it.
    """
    fraction = _fraction(hot_rows)
    seen = df.select(*keys)
    if fraction < 1.0:
        seen = seen.sample(fraction, seed=1)
    counts = (seen.groupBy(*keys).agg(F.count(F.lit(1)).alias(FAN))
              .where(F.col(FAN) > hot_rows * fraction))
    return _hot(counts, keys, counts.orderBy(F.desc(FAN)).limit(_partitions(df)).collect(), hot_rows)


def hot_keys_of_all(df: DataFrame, sets: Sequence[Sequence[str]], hot_rows: int = HOT_ROWS) -> list[DataFrame | None]:
    """`hot_keys` for several keys of one frame, from one sampled count with a grouping set per key."""
    if not sets:
        return []
    columns = list(dict.fromkeys(c for keys in sets for c in keys))
    fraction, several = _fraction(hot_rows), [list(dict.fromkeys(keys)) for keys in sets]
    seen = df.select(*columns)
    if fraction < 1.0:
        seen = seen.sample(fraction, seed=1)
    different = [list(k) for k in dict.fromkeys(map(tuple, several))]
    counts = (seen.groupingSets([[F.col(c) for c in keys] for keys in different], *columns)
              .agg(F.count(F.lit(1)).alias(FAN), F.grouping_id(*columns).alias("_set")).where(F.col(FAN) > hot_rows * fraction))
    first = Window.partitionBy("_set").orderBy(F.desc(FAN))
    found = (counts.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= _partitions(df)).collect())
    # grouping_id has a bit for every column that a set does not group by, the first column highest.
    number = {tuple(keys): sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in keys) for keys in different}
    return [_hot(counts, keys, [r for r in found if r["_set"] == number[tuple(keys)]], hot_rows) for keys in several]


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], hot: DataFrame | None, how: str = "left") -> DataFrame:
    """left or inner join on `keys`, which both sides have, with the rows of hot keys dealt to several tasks.

    Rows of `left` with a hot key get a salt, those of `right` one copy per salt; rows with a NULL key,
    which match nothing, are dealt out as well.  Both sides keep all their other columns.
    """
    keys = list(keys)
    more = [c for c in right.columns if c not in keys]
    if hot is None:
        joined = left.join(right, _equal(left, right, keys), how)
        return joined.select(*[left[c] for c in left.columns], *[right[c] for c in more])
    hot = F.broadcast(hot.dropna(subset=keys))
    # The place where a row was written tells equal rows apart; without one they share a salt.
    told = [left[PLACE]] if PLACE in left.columns else [left[c] for c in left.columns]
    row_hash = F.xxhash64(*told)
    unmatched = reduce(Column.__or__, [left[k].isNull() for k in keys])
    salt = (F.when(hot[FAN].isNotNull(), F.pmod(row_hash, hot[FAN]))
            .when(unmatched, F.pmod(row_hash, F.lit(_partitions(left)))).otherwise(0))
    dealt = (left.join(hot, _equal(left, hot, keys), "left")
             .select(*[left[c] for c in left.columns], salt.cast("int").alias(SALT)))
    copies = F.explode(F.sequence(F.lit(0), F.coalesce(hot[FAN], F.lit(1)) - 1))
    copied = (right.join(hot, _equal(right, hot, keys), "left")
              .select(*[right[c] for c in right.columns], copies.alias(SALT)))
    joined = dealt.join(copied, _equal(dealt, copied, [*keys, SALT]), how)
    return joined.select(*[dealt[c] for c in left.columns], *[copied[c] for c in more])


def dealt_join(left: DataFrame, right: DataFrame, on: Column, pairs: Sequence[tuple[Column, Column]], hot: DataFrame,
               how: str = "left") -> DataFrame:
    """left or inner join on any condition with the equalities `pairs`; rows of hot keys are dealt to several tasks.

    As `salted_join`, for sides whose columns are told apart by table names,
    which stay.  `hot` has one column per pair, in their order.
    """
    keys = hot.columns[:-1]

    def beside(df: DataFrame, columns: Sequence[Column], side: str) -> DataFrame:
        names = [f"_hot_{side}{i}" for i in range(len(keys))]
        few = F.broadcast(hot.dropna(subset=keys).select(
            *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col(FAN).alias(f"_fan_{side}")))
        return df.join(few, reduce(Column.__and__, [c == F.col(n) for c, n in zip(columns, names)]), "left").drop(*names)

    first, second = beside(left, [c for c, _ in pairs], "l"), beside(right, [c for _, c in pairs], "r")
    unmatched = reduce(Column.__or__, [c.isNull() for c, _ in pairs])
    row_hash = F.xxhash64(*[c for c in _all_columns(left)])
    salt = (F.when(F.col("_fan_l").isNotNull(), F.pmod(row_hash, F.col("_fan_l")))
            .when(unmatched, F.pmod(row_hash, F.lit(_partitions(left)))).otherwise(0).cast("int"))
    first = first.withColumn("_salt_l", salt).drop("_fan_l")
    second = second.withColumn("_salt_r", F.explode(F.sequence(F.lit(0), F.coalesce("_fan_r", F.lit(1)) - 1))).drop("_fan_r")
    return first.join(second, on & (F.col("_salt_l") == F.col("_salt_r")), how).drop("_salt_l", "_salt_r")


def _all_columns(df: DataFrame) -> list[Column]:
    """A hashable struct of all columns, also where several tables have columns of one name."""
    return [F.struct("*")]


#: In the place of a frame of hot keys: look for them.
LOOK = object()


def attach(fact: DataFrame, dim: DataFrame, keys: Sequence[str], how: str = "left", *,
           hot_rows: int | None = HOT_ROWS, sizes: DataFrame | None = None, hot: DataFrame | None | object = LOOK) -> DataFrame:
    """Join `dim` (unique on `keys`) to `fact`; `how` is left or inner.  NULL keys never match.

    A dim that Spark plans to broadcast, or a fact without hot keys, is Spark's own join.
    Hot keys get a salt on the fact side and as many copies of their one row on
    the dim side.  Rows with a NULL key are spread the same way.  `sizes` has the
    keys of `fact` where these are cheaper to read than from `fact` itself; `hot`
    are its hot keys if they are known.
    """
    keys = list(keys)
    # Renewed columns, so that a dim made from the fact is told apart from it.
    dim = dim.select(*[F.col(c).alias(c) for c in dim.columns])
    if planned_small(dim) or hot_rows is None:
        hot = None
    elif hot is LOOK:
        hot = hot_keys(fact if sizes is None else sizes, keys, hot_rows)
    return salted_join(fact, dim, keys, hot, how)


# --- ordered scans ------------------------------------------------------------------


@dataclass(frozen=True)
class Scan:
    """What `keyed_scan` adds: the value of an expression at another row of the same key.

    kind is `previous` (row before), `next` (row after) or `latest` (last
    non-NULL value up to and including this row).
    """

    kind: str
    value: Column


def slice_hot_keys(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column],
                   hot_rows: int = HOT_ROWS, sizes: DataFrame | None = None) -> DataFrame:
    """df with a slice number: 0 for ordinary keys, ranges of (keys, order) for hot ones.

    Only the rows of hot keys are written to the shared folder, because their
    slice is the number of the range partition they fell into and must not
    change between two reads.  Without hot keys df comes back as it is.  `sizes`
    is as in `attach`.
    """
    hot = hot_keys(df if sizes is None else sizes, keys, hot_rows)
    if hot is None:
        return df
    hot = F.broadcast(hot)
    ranges = (df.join(hot, _same(df, hot, keys), "left_semi")
              .repartitionByRange(_partitions(df), *keys, *order)
              .withColumn(SLICE, F.spark_partition_id() + 1))
    rest = df.join(hot, _same(df, hot, keys), "left_anti").withColumn(SLICE, F.lit(0))
    return rest.unionByName(materialise(ranges, "slices"))


def keyed_scan(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               scans: Mapping[str, Scan]) -> DataFrame:
    """Add one column per scan, looking at the rows of the same key in ascending `order`.

    `order` must be unique within a key and is taken with NULLs first.  If df
    carries slices, each slice is a window of its own and receives what lies
    before and after it from a summary with one row per slice.
    """
    keys = list(keys)
    sliced = SLICE in df.columns
    group = keys + [SLICE] if sliced else keys
    window = Window.partitionBy(*group).orderBy(*order)
    inside = {"previous": lambda v: F.lag(v).over(window),
              "next": lambda v: F.lead(v).over(window),
              "latest": lambda v: F.last(v, ignorenulls=True).over(
                  window.rowsBetween(Window.unboundedPreceding, Window.currentRow))}
    # A value is boxed so that a NULL found at the other row differs from no row there.
    boxed = {name: F.struct(s.value.alias("v")) if s.kind != "latest"
             else F.when(s.value.isNotNull(), F.struct(s.value.alias("v")))
             for name, s in scans.items()}
    local = {name: inside[s.kind](boxed[name]) for name, s in scans.items()}
    if not sliced:
        return df.withColumns({name: c["v"] for name, c in local.items()})

    position = F.struct(*order)
    edge = {"previous": lambda v: F.max_by(v, position),
            "next": lambda v: F.min_by(v, position),
            "latest": lambda v: F.max_by(v, F.when(v.isNotNull(), position))}
    edges = (df.where(F.col(SLICE) > 0).groupBy(*group)
             .agg(*[edge[s.kind](boxed[name]).alias(name) for name, s in scans.items()]))
    over_slices = Window.partitionBy(*keys).orderBy(SLICE)
    outside = {"previous": lambda c: F.lag(c).over(over_slices),
               "next": lambda c: F.lead(c).over(over_slices),
               "latest": lambda c: F.last(c, ignorenulls=True).over(
                   over_slices.rowsBetween(Window.unboundedPreceding, -1))}
    # One row per slice and key in it: as many as partitions and hot keys, so it is broadcast.
    carried = F.broadcast(edges.select(
        *[F.col(c).alias(f"_at_{c}") for c in group],
        *[outside[s.kind](F.col(name)).alias(f"_out_{name}") for name, s in scans.items()]))
    here = df.withColumns({f"_in_{name}": c for name, c in local.items()})
    match = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in group])
    joined = here.join(carried, match, "left")
    return joined.select(
        *df.columns,
        *[F.coalesce(f"_in_{name}", f"_out_{name}")["v"].alias(name) for name in scans])
