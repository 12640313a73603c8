"""Load strategies as DataFrame -> DataFrame functions; `sources.warehouse` writes the results.

The upsert and version rules are chosen here: the names of the strategies are
all that is given.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starload.functions.library import hashdiff
from starload.operators.keys import highest, number_rows
from starload.operators.skew import HOT_ROWS, Scan, attach, keyed_scan, slice_hot_keys
from starload.scratch import materialise
from starload.spec import HASHDIFF, IS_CURRENT, VALID_FROM, VALID_TO

CHANGE = "change"
# What happened to a key between the current versions and a snapshot.
NEW, CHANGED, UNCHANGED, MISSING, LATE = "new", "changed", "unchanged", "missing", "late"


def newest_of(target: DataFrame, ts: str, loaded: DataFrame | None = None) -> Column | None:
    """The newest `ts` of target as a constant, which prunes partitions and skips row groups; None if there is none.

    With `loaded`, a fingerprint of all rows of target, only the last range of time is read.
    """
    if loaded is not None:
        last = loaded.agg(F.max(RANGE)).first()[0]
        target = target.where(F.col(ts) >= F.lit(last).cast(target.schema[ts].dataType)) if last else target
    if isinstance(target.schema[ts].dataType, T.TimestampType):
        # An instant travels as a number, whose meaning no time zone changes.
        newest = target.agg(F.unix_micros(F.max(ts))).first()[0]
        return None if newest is None else F.timestamp_micros(F.lit(newest))
    newest = target.agg(F.max(ts).cast("string")).first()[0]
    return None if newest is None else F.lit(newest).cast(target.schema[ts].dataType)


def _not_in(source: DataFrame, target: DataFrame, keys: Mapping[str, str | Column]) -> DataFrame:
    """Rows of source whose key no row of target has; keys: target column -> column over source."""
    names = {c: f"_key_{i}" for i, c in enumerate(keys)}
    marked = source.select("*", *[(F.col(e) if isinstance(e, str) else e).alias(names[c]) for c, e in keys.items()])
    known = target.select(*[F.col(c).alias(f"_known{names[c]}") for c in keys])
    same = reduce(Column.__and__, [F.col(n).eqNullSafe(F.col(f"_known{n}")) for n in names.values()])
    return marked.join(known, same, "left_anti").drop(*names.values())


def newer_rows(source: DataFrame, target: DataFrame, ts: str, source_ts: str | None = None,
               keys: Mapping[str, str | Column] | None = None, loaded: DataFrame | None = None) -> DataFrame:
    """Rows of `source` that an append to `target` still has to load; all of them while target is empty.

    These are the rows after the newest `ts` of target and, with `keys` (target
    column -> column over source), those at that very moment or without a
    timestamp whose key target does not have yet.  Without keys such rows cannot
    be told from loaded ones and are left out.  `older_rows` has the rest;
    `loaded` is as there.
    """
    column, newest = F.col(source_ts or ts), newest_of(target, ts, loaded)
    if newest is None and keys is None:
        return source
    if keys is None:
        return source.where(column > newest)
    undated = _not_in(source.where(column.isNull()), target.where(F.col(ts).isNull()), keys)
    if newest is None:
        return source.where(column.isNotNull()).unionByName(undated)
    edge = _not_in(source.where(column == newest), target.where(F.col(ts) == newest), keys)
    return source.where(column > newest).unionByName(edge).unionByName(undated)


def older_rows(source: DataFrame, target: DataFrame, ts: str, keys: Mapping[str, str | Column],
               source_ts: str | None = None, loaded: DataFrame | None = None, unit: str = "month") -> DataFrame:
    """Rows of `source` before the newest `ts` of target that were never loaded: they arrived too late.

    With `loaded`, a fingerprint of all rows of target, only ranges of time are
    joined in which the source has other keys, and the range of the newest row.
    """
    name = source_ts or ts
    column, newest = F.col(name), newest_of(target, ts, loaded)
    if newest is None:
        return source.where(F.lit(False))
    older, known = source.where(column < newest), target.where(F.col(ts) < newest)
    if loaded is not None:
        ranges = changed_ranges(fingerprint(older, name, keys, unit), loaded)
        # Rows at the newest moment are not older, but count in what was loaded, so the last range is always joined.
        older = older.where(in_ranges(name, ranges, unit, source.schema[name].dataType))
        known = known.where(in_ranges(ts, ranges, unit, target.schema[ts].dataType))
    return _not_in(older, known, keys)


# --- what was loaded, by ranges of time ---------------------------------------------------

# Columns of a fingerprint.
RANGE, ROWS, KEY_SUM = "range", "rows", "key_sum"


def fingerprint(df: DataFrame, ts: str, keys: Mapping[str, str | Column], unit: str = "month") -> DataFrame:
    """(range, rows, key_sum): rows per range of time and a sum of key hashes, in which the order does not matter.

    Two sets of rows with the same fingerprint have the same keys in that range,
    but for collisions of 64-bit hashes.  Rows without a moment are a range of their own.
    Counted before the shuffle: what moves is one row per range and task.
    """
    hashed = F.xxhash64(*[F.col(k) if isinstance(k, str) else k for k in keys.values()]).cast("decimal(20,0)")
    at = F.date_trunc(unit, F.col(ts)).cast("date")
    return df.select(at.alias(RANGE), hashed.alias("_hash")).groupBy(RANGE).agg(
        F.count(F.lit(1)).alias(ROWS), F.sum("_hash").cast("decimal(38,0)").alias(KEY_SUM))


def changed_ranges(source: DataFrame, loaded: DataFrame) -> list:
    """The ranges (dates) of a source fingerprint that differ from what was loaded; as many as ranges at most."""
    told = loaded.groupBy(RANGE).agg(F.sum(ROWS).alias("_rows"), F.sum(KEY_SUM).alias("_sum"))
    both = source.join(told, RANGE, "left").where(
        F.col(RANGE).isNotNull() & ~(F.col(ROWS).eqNullSafe(F.col("_rows")) & F.col(KEY_SUM).eqNullSafe(F.col("_sum"))))
    return sorted(r[0] for r in both.select(RANGE).collect())


def in_ranges(ts: str, ranges: Sequence, unit: str = "month", kind: T.DataType | None = None) -> Column:
    """Whether a moment lies in one of the ranges, as bounds that reach the scan; neighbours become one interval."""
    kind = kind or T.TimestampNTZType()
    nexts = [F.add_months(F.lit(r), {"year": 12, "quarter": 3, "month": 1}[unit]) if unit in ("year", "quarter", "month")
             else F.date_add(F.lit(r), {"week": 7, "day": 1}[unit]) for r in ranges]
    inside = [(F.col(ts) >= F.lit(r).cast(kind)) & (F.col(ts) < n.cast(kind)) for r, n in zip(ranges, nexts)]
    return reduce(Column.__or__, inside, F.lit(False))


def _with_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df; a NULL key fails the job, as such a row could never be found again."""
    return df.withColumns({k: F.coalesce(F.col(k), F.raise_error(F.lit(f"NULL in key column {k}"))) for k in keys})


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last one in `order`; combined before the shuffle.

    Of rows equal in `order` the one with the largest values wins, column by
    column, so that every run and every partitioning gives the same row.
    """
    df = _with_keys(df, keys)
    first = [c for c in dict.fromkeys(order) if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in first]
    row = F.max(F.struct(*first, *rest)).alias("_row")
    # The keys stay the grouping columns, so that a join on them needs no further shuffle.
    return df.groupBy(*keys).agg(row).select(
        *[F.col(c) if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str, *, unique: bool = False) -> DataFrame:
    """`target` (unique on keys) with the rows of `batch` put in; per key the latest `order` wins.

    A batch row wins a tie.  The batch may repeat keys, unless it is said to be
    `unique`.  Only the batch and the key columns of the target need to move
    while the batch is small.
    """
    rename = {k: f"_b_{k}" for k in [*keys, order]}
    batch = batch if unique else latest_rows(batch, keys, [order])
    marks = batch.select(*[F.col(k).alias(n) for k, n in rename.items()])
    same = reduce(Column.__and__, [F.col(k) == F.col(rename[k]) for k in keys])
    stale = F.coalesce(F.col(rename[order]) < F.col(order),
                       F.col(order).isNotNull() & F.col(rename[order]).isNull())
    kept = target.join(marks, same & ~stale, "left_anti")
    losers = (target.select(*keys, order).join(marks, same & stale, "inner")
              .select(*[rename[k] for k in keys]))
    won = batch.join(losers, same, "left_anti")
    return kept.unionByName(won)


def winners(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: str, more: Sequence[str] = ()) -> DataFrame:
    """Rows of `batch` (unique on keys) that an upsert puts in, with `_known` and the target's own `more` as `_old_<name>`.

    A row loses against a later `order` in target and wins a tie.
    """
    known = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], F.col(order).alias("_t_order"),
                          *[F.col(c).alias(f"_old_{c}") for c in more], F.lit(True).alias("_known"))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_t_{k}") for k in keys])
    stale = F.coalesce(F.col(order) < F.col("_t_order"), F.col("_t_order").isNotNull() & F.col(order).isNull())
    found = batch.join(known, same, "left").where(F.col("_known").isNull() | ~stale)
    return found.select(*batch.columns, F.coalesce("_known", F.lit(False)).alias("_known"), *[f"_old_{c}" for c in more])


def keep_keys(batch: DataFrame, target: DataFrame, keys: Sequence[str], generated: Sequence[str]) -> DataFrame:
    """`batch` (unique on keys) with the generated keys that its rows already have in `target`.

    The other rows are numbered after the highest key of `target`, without gaps,
    in the order of the numbers that they come with.
    """
    if not generated:
        return batch
    known = target.select(*keys, *[F.col(g).alias(f"_known_{g}") for g in generated])
    found = materialise(attach(batch, known, keys), "known-keys")
    first = F.col(f"_known_{generated[0]}")
    old = found.where(first.isNotNull()).select(*[F.col(f"_known_{c}").alias(c) if c in generated else c for c in batch.columns])
    new = number_rows(found.where(first.isNull()).select(batch.columns), [generated[0]], "_number", unique=True)
    new = new.select(*[(highest(target, c) + F.col("_number")).cast(batch.schema[c].dataType).alias(c) if c in generated
                       else F.col(c) for c in batch.columns])
    return old.unionByName(new)


# --- versioned dimensions -----------------------------------------------------------


def compare_versions(target: DataFrame, snapshot: DataFrame, keys: Sequence[str],
                     tracked: Sequence[str], ts: str) -> DataFrame:
    """Current versions against a snapshot, one row per key, with what happened to it.

    The result has `change`, `old` (the current version) and `new` (the snapshot
    row).  A snapshot row that changes a key at or before the moment its current
    version began is `late`.  A snapshot may repeat a key; its latest row counts.
    """
    current = target.where(IS_CURRENT).select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*target.columns).alias("old"))
    fresh = latest_rows(snapshot, keys, [ts, *tracked]).withColumn(HASHDIFF, hashdiff(*map(F.col, tracked)))
    fresh = fresh.select(*keys, F.struct(*fresh.columns).alias("new"))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_o_{k}") for k in keys])
    change = (F.when(F.col("old").isNull(), NEW)
              .when(F.col("new").isNull(), MISSING)
              .when(F.col(f"old.{HASHDIFF}") == F.col(f"new.{HASHDIFF}"), UNCHANGED)
              .when(F.col(f"new.{ts}") <= F.col(f"old.{VALID_FROM}"), LATE)
              .otherwise(CHANGED))
    return current.join(fresh, same, "full_outer").select(change.alias(CHANGE), "old", "new")


def against_current(current: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                    ts: str) -> DataFrame:
    """Every row of a batch (`new`) with the current version of its key (`old`), and what it is: `change`."""
    current = current.select(*[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*current.columns).alias("old"))
    fresh = _with_keys(batch, [*keys, ts]).withColumn(HASHDIFF, hashdiff(*map(F.col, tracked)))
    fresh = fresh.select(*keys, F.struct(*fresh.columns).alias("new"))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_o_{k}") for k in keys])
    change = (F.when(F.col("old").isNull(), NEW)
              .when(F.col(f"new.{ts}") > F.col(f"old.{VALID_FROM}"), CHANGED)
              .when(F.col(f"old.{HASHDIFF}") == F.col(f"new.{HASHDIFF}"), UNCHANGED).otherwise(LATE))
    return fresh.join(current, same, "left").select(*keys, change.alias(CHANGE), "old", "new")


def late_of(placed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Of a batch that was held against the current versions: the rows that come too late."""
    return placed.where(F.col(CHANGE) == LATE).select("new.*").select(*columns)


def _changes(placed: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str, hot_rows: int) -> DataFrame:
    """Rows of (keys, old, new) that begin a version, with `_next` (when it ends) and `_prior` (NULL for the first)."""
    rows = placed.select(*keys, F.col(f"new.{ts}").alias("_at"), F.struct(*[F.col(f"new.{c}") for c in tracked]).alias("_tie"),
                         "old", "new")
    order = ["_at", "_tie"]
    rows = slice_hot_keys(rows, keys, order, hot_rows)
    rows = keyed_scan(rows, keys, order, {"_same": Scan("next", F.col("_at"))})
    # Of two rows at one moment the last in order counts, as in `latest_rows`.
    rows = rows.where(F.col("_same").isNull() | (F.col("_same") > F.col("_at"))).drop("_same")
    rows = keyed_scan(rows, keys, order, {"_before": Scan("previous", F.col(f"new.{HASHDIFF}"))})
    before = F.coalesce(F.col("_before"), F.col(f"old.{HASHDIFF}"))
    rows = rows.where(before.isNull() | (before != F.col(f"new.{HASHDIFF}"))).drop("_before")
    return keyed_scan(rows, keys, order, {"_next": Scan("next", F.col("_at")), "_prior": Scan("previous", F.col("_at"))})


def version_rows(placed: DataFrame, target: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str, *,
                 generated: Sequence[str] = (), hot_rows: int = HOT_ROWS) -> DataFrame:
    """The versions that a batch closes and opens, with the columns of target; unique on keys and valid_from.

    `placed` is a batch held against the current versions, written by the
    caller, as it is read several times.  `generated` columns of new versions are numbered without gaps after
    the highest of target, in the order of the values that the batch has there.
    """
    fresh = [f.name for f in placed.schema["new"].dataType]
    candidates = placed.where(F.col(CHANGE).isin(NEW, CHANGED))
    if placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty():
        # A key with one row has one change at most: nothing has to be put in order.
        differs = F.col("old").isNull() | (F.col(f"old.{HASHDIFF}") != F.col(f"new.{HASHDIFF}"))
        none = F.lit(None).cast(placed.schema["new"].dataType[ts].dataType)
        changes = candidates.where(differs).select(*keys, "old", "new", none.alias("_next"), none.alias("_prior"))
    else:
        changes = _changes(candidates, keys, tracked, ts, hot_rows).select(*keys, "old", "new", "_next", "_prior")
        if not generated:
            changes = materialise(changes, "changes")
    numbers: dict[str, Column] = {}
    if generated:
        changes = number_rows(changes, [F.col(f"new.{generated[0]}")], "_number", unique=True)
        numbers = {g: F.col("_number") + highest(target, g) for g in generated}
    ends = target.schema[VALID_TO].dataType
    opened = changes.select(_version(
        target, lambda c: F.col(f"new.{c}") if c in fresh else F.lit(None),
        {VALID_FROM: F.col(f"new.{ts}"), VALID_TO: F.col("_next").cast(ends),
         IS_CURRENT: F.col("_next").isNull(), **numbers}).alias("_version")).select("_version.*")
    first = changes.where(F.col("_prior").isNull() & F.col("old").isNotNull())
    closed = first.select(_version(target, lambda c: F.col(f"old.{c}"), {
        VALID_TO: F.col(f"new.{ts}").cast(ends), IS_CURRENT: F.lit(False)}).alias("_version")).select("_version.*")
    return closed.unionByName(opened)


def ended_versions(current: DataFrame, batch: DataFrame, keys: Sequence[str], closed_at: Column) -> DataFrame:
    """The current versions of keys that a batch does not have any more, closed."""
    gone = _not_in(current, batch.select(*keys), {k: k for k in keys})
    return gone.select(_version(current, F.col, {VALID_TO: closed_at, IS_CURRENT: F.lit(False)})
                       .alias("_version")).select("_version.*")


def apply_versions(target: DataFrame, batch: DataFrame, keys: Sequence[str],
                   tracked: Sequence[str], ts: str, *, close_missing: bool = False,
                   closed_at: Column | None = None, generated: Sequence[str] = (),
                   hot_rows: int = HOT_ROWS) -> DataFrame:
    """The versioned table after a batch of changes: changed versions closed, new ones opened.

    The target has the keys, the tracked columns, hashdiff, valid_from, valid_to
    and is_current.  A batch may have several rows of a key: each change among
    them is a version, which ends where the next one begins.  Late rows are not
    applied (see `late_rows`).  A key missing from the batch stays open unless
    `close_missing`, which needs `closed_at`.  `generated` is as in
    `version_rows`.  Without it, a batch with one row per key is one join; any other is
    held against the current versions once and written.
    """
    history = target.where(~F.coalesce(F.col(IS_CURRENT), F.lit(False)))
    once = not generated and batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").isEmpty()
    if once:
        return history.unionByName(_applied_once(target, batch, keys, tracked, ts, closed_at if close_missing else None))
    current = target.where(IS_CURRENT)
    placed = materialise(against_current(current, batch, keys, tracked, ts), "placed")
    rows = version_rows(placed, target, keys, tracked, ts, generated=generated, hot_rows=hot_rows)
    if close_missing:
        rows = rows.unionByName(ended_versions(current, batch, keys, closed_at))
    rows = materialise(rows, "versions")
    still = _not_in(current, rows.where(~F.col(IS_CURRENT)).select(*keys, VALID_FROM), {c: c for c in [*keys, VALID_FROM]})
    return history.unionByName(still).unionByName(rows)


def _applied_once(target: DataFrame, batch: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str,
                  closed_at: Column | None) -> DataFrame:
    """What becomes of the current versions with a batch of one row per key: one join, no row is read twice."""
    current = target.where(IS_CURRENT).select(
        *[F.col(k).alias(f"_o_{k}") for k in keys], F.struct(*target.columns).alias("old"))
    fresh = _with_keys(batch, [*keys, ts]).withColumn(HASHDIFF, hashdiff(*map(F.col, tracked)))
    columns = fresh.columns
    fresh = fresh.select(*keys, F.struct(*columns).alias("new"))
    same = reduce(Column.__and__, [F.col(k) == F.col(f"_o_{k}") for k in keys])
    ends = target.schema[VALID_TO].dataType

    def ended(at: Column) -> Column:
        return _version(target, lambda c: F.col(f"old.{c}"), {VALID_TO: at.cast(ends), IS_CURRENT: F.lit(False)})
    opened = _version(target, lambda c: F.col(f"new.{c}") if c in columns else F.lit(None), {
        VALID_FROM: F.col(f"new.{ts}"), VALID_TO: F.lit(None), IS_CURRENT: F.lit(True)})
    stays = _version(target, lambda c: F.col(f"old.{c}"), {})
    changed = ((F.col(f"new.{ts}") > F.col(f"old.{VALID_FROM}")) & (F.col(f"new.{HASHDIFF}") != F.col(f"old.{HASHDIFF}")))
    became = (F.when(F.col("old").isNull(), F.array(opened))
              .when(F.col("new").isNull(), F.array(stays if closed_at is None else ended(closed_at)))
              .when(changed, F.array(ended(F.col(f"new.{ts}")), opened)).otherwise(F.array(stays)))
    return current.join(fresh, same, "full_outer").select(F.explode(became).alias("_version")).select("_version.*")


def _version(target: DataFrame, value, replaced: dict[str, Column]) -> Column:
    """A struct with the target's columns and types."""
    return F.struct(*[replaced.get(f.name, value(f.name)).cast(f.dataType).alias(f.name)
                      for f in target.schema])


def late_rows(target: DataFrame, batch: DataFrame, keys: Sequence[str],
              tracked: Sequence[str], ts: str) -> DataFrame:
    """Batch rows that `apply_versions` leaves out because they are too old."""
    return late_of(against_current(target.where(IS_CURRENT), batch, keys, tracked, ts), batch.columns)


def initial_versions(batch: DataFrame, keys: Sequence[str], tracked: Sequence[str], ts: str, *,
                     hot_rows: int = HOT_ROWS) -> DataFrame:
    """A versioned table with the versions of a first batch."""
    rows = _with_keys(batch.select(*keys, *tracked, ts), [*keys, ts]).withColumn(HASHDIFF, hashdiff(*map(F.col, tracked)))
    none = F.lit(None).cast(T.StructType([T.StructField(HASHDIFF, T.StringType())]))
    placed = rows.select(*keys, none.alias("old"), F.struct(*rows.columns).alias("new"))
    return _changes(placed, keys, tracked, ts, hot_rows).select(
        *keys, *[F.col(f"new.{c}").alias(c) for c in [*tracked, HASHDIFF]], F.col("_at").alias(VALID_FROM),
        F.col("_next").cast(batch.schema[ts].dataType).alias(VALID_TO), F.col("_next").isNull().alias(IS_CURRENT))


def version_history(feed: DataFrame, keys: Sequence[str], tracked: Sequence[str],
                    order: Sequence[str], *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """All versions in a change feed: a row per change of the tracked columns.

    `order` starts with the timestamp that bounds the versions; its other
    columns make it unique within a key.
    """
    ts = order[0]
    rows = feed.select(*dict.fromkeys([*keys, *tracked, *order]))
    rows = slice_hot_keys(rows, keys, order, hot_rows)
    state = F.struct(*tracked)
    before = keyed_scan(rows, keys, order, {"_before": Scan("previous", state)})
    changes = before.where(F.col("_before").isNull() | ~state.eqNullSafe(F.col("_before")))
    versions = keyed_scan(changes.drop("_before"), keys, order, {VALID_TO: Scan("next", F.col(ts))})
    return versions.select(
        *keys, *tracked, hashdiff(*map(F.col, tracked)).alias(HASHDIFF), F.col(ts).alias(VALID_FROM),
        VALID_TO, F.col(VALID_TO).isNull().alias(IS_CURRENT))
