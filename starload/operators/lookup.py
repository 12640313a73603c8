"""Dimension lookups: natural key to surrogate key, plain and by validity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from starload.operators.skew import HOT_ROWS, LOOK, SLICE, Scan, attach, keyed_scan, planned_small, slice_hot_keys


def lookup(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], take: Mapping[str, str], *,
           unknown_key: Any = None, unique: str = "trust", hot_rows: int | None = HOT_ROWS,
           sizes: DataFrame | None = None, hot: DataFrame | None | object = LOOK) -> DataFrame:
    """Add columns of `dim` to `fact`; every fact row stays, a miss gives `unknown_key` or NULL.

    `on` pairs fact columns with dim columns, `take` names result column ->
    dim column.  A NULL fact key never matches.  The dim must be unique on its
    side of `on`; unique='verify' fails the job when it is not.  `sizes` is a
    frame with the same keys as `fact` that is cheaper to read, `hot` the hot
    keys if they are known.
    """
    keys = [f for f, _ in on]
    side = dim.select(*[dim[d].alias(f) for f, d in on], *[dim[c].alias(name) for name, c in take.items()])
    side = side.where(_all_set(keys))
    if unique == "verify":
        side = unique_rows(side, keys)
    joined = attach(fact, side, keys, "left", hot_rows=hot_rows, sizes=sizes, hot=hot)
    if unknown_key is None:
        return joined
    return joined.withColumns({name: F.coalesce(joined[name], F.lit(unknown_key)) for name in take})


def _keys_of(versions: DataFrame, facts: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    return versions.select(*keys).union(facts.select(*names))


def _all_set(columns: Sequence[str]) -> Column:
    return reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])


def unique_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df itself if it is unique on `keys`; the job fails on the first key that is not."""
    rest = [c for c in df.columns if c not in keys]
    packed = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"),
                                   F.max(F.struct(*(rest or keys))).alias("_row"))
    message = F.concat(F.lit(f"more than one row for ({', '.join(keys)}) = "),
                       F.to_json(F.struct(*keys)))
    checked = packed.withColumn("_row", F.when(F.col("_rows") == 1, F.col("_row"))
                                .otherwise(F.raise_error(message)))
    return checked.select(*[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def overlapping_versions(dim: DataFrame, keys: Sequence[str], valid_from: str = "valid_from",
                         valid_to: str = "valid_to") -> DataFrame:
    """Versions that are still valid when the next one of their key begins; empty ones overlap nothing."""
    lasting = dim.where(F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from))).select(*keys, valid_from, valid_to)
    rows = slice_hot_keys(lasting, keys, [valid_from])
    following = keyed_scan(rows, keys, [valid_from], {"_next": Scan("next", F.col(valid_from))})
    return following.where(F.col("_next").isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col("_next"))))


def _as_of_small(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], at: str, take: Mapping[str, str],
                 valid_from: str, valid_to: str, unknown_key: Any) -> DataFrame:
    """`lookup_as_of` for a dim that may be broadcast: the versions of a key as one sorted array, so no fact moves."""
    keys = [f"_k{i}" for i in range(len(on))]
    version = F.struct(dim[valid_from].alias("since"), dim[valid_to].alias("until"),
                       F.struct(*[dim[c].alias(n) for n, c in take.items()]).alias("taken"))
    versions = (dim.where(dim[valid_to].isNull() | (dim[valid_to] > dim[valid_from]))
                .select(*[dim[d].alias(k) for k, (_, d) in zip(keys, on)], version.alias("_version"))
                .groupBy(*keys).agg(F.sort_array(F.collect_list("_version")).alias("_versions")))
    same = reduce(Column.__and__, [fact[f] == F.col(k) for k, (f, _) in zip(keys, on)])
    begun = F.filter("_versions", lambda v: v["since"] <= fact[at])
    last = F.element_at(begun, -1)
    joined = fact.join(F.broadcast(versions), same, "left").withColumn("_found", F.when(F.size(begun) > 0, last))
    valid = (fact[at] < F.col("_found.until")) | F.col("_found.until").isNull()
    picked = {n: F.when(valid, F.col("_found.taken")[n]) for n in take}
    if unknown_key is not None:
        picked = {n: F.coalesce(c, F.lit(unknown_key)) for n, c in picked.items()}
    return joined.select(*[fact[c] for c in fact.columns], *[c.alias(n) for n, c in picked.items()])


def lookup_as_of(fact: DataFrame, dim: DataFrame, on: Sequence[tuple[str, str]], at: str,
                 take: Mapping[str, str], *, valid_from: str = "valid_from", valid_to: str = "valid_to",
                 unknown_key: Any = None, hot_rows: int = HOT_ROWS,
                 sizes: DataFrame | None = None) -> DataFrame:
    """Add columns of the dim version with valid_from <= `at` < valid_to (NULL: still open).

    Versions of one key must not overlap (see `overlapping_versions`).  A dim that
    Spark plans to broadcast is, and facts stay where they are.  Beyond that,
    facts and versions are brought into one order per key and the latest version
    is carried forward, so the work is linear in both, whatever number of versions
    a key has.  `sizes` is as in `lookup`.
    """
    if planned_small(dim):
        return _as_of_small(fact, dim, on, at, take, valid_from, valid_to, unknown_key)
    keys = [f"_k{i}" for i in range(len(on))]
    payload = F.struct(dim[valid_to].alias("until"), *[dim[c].alias(n) for n, c in take.items()])
    opened = dim[valid_to].isNull() | (dim[valid_to] > dim[valid_from])
    versions = dim.where(opened).select(
        *[dim[d].alias(k) for k, (_, d) in zip(keys, on)],
        dim[valid_from].alias("_at"), F.lit(0).alias("_is_fact"), payload.alias("_version"))
    versions = versions.where(_all_set(keys))
    facts = fact.select(
        *[fact[f].alias(k) for k, (f, _) in zip(keys, on)],
        fact[at].alias("_at"), F.lit(1).alias("_is_fact"), F.struct(*fact.columns).alias("_fact"))
    rows = versions.unionByName(facts, allowMissingColumns=True)
    order = ["_at", "_is_fact"]
    # Facts at one moment see the same version, so their order does not matter;
    # their hash only lets a hot key be cut between them.
    rows = slice_hot_keys(rows, keys, [*order, F.xxhash64("_fact")], hot_rows,
                          None if sizes is None else _keys_of(versions, sizes, keys, [f for f, _ in on]))
    found = keyed_scan(rows, keys, order, {"_found": Scan("latest", F.col("_version"))})
    found = found.where("_is_fact = 1").drop(SLICE)
    valid = (F.col("_at") < F.col("_found.until")) | F.col("_found.until").isNull()
    picked = {n: F.when(valid, F.col("_found")[n]) for n in take}
    if unknown_key is not None:
        picked = {n: F.coalesce(c, F.lit(unknown_key)) for n, c in picked.items()}
    return found.select("_fact.*", *[c.alias(n) for n, c in picked.items()])
