
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starload.operators import load

KEYS, TRACKED = ["k"], ["s"]


def snapshot(spark, data):
    return spark.createDataFrame(data, "k int, s string, at int")


def test_newer_rows(spark):
    source = spark.createDataFrame([(1, 5), (2, 9)], "id int, ts int")
    target = spark.createDataFrame([(1, 5)], "id int, ts int")
    assert rows(load.newer_rows(source, target, "ts")) == [(2, 9)]
    assert rows(load.newer_rows(source, target.where("id < 0"), "ts")) == [(1, 5), (2, 9)]


def test_newer_rows_of_instants_in_the_hour_that_comes_twice(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        hours = spark.range(6).select("id", F.timestamp_seconds(F.lit(1730606400) + F.col("id") * 3600).alias("ts"))
        for n in range(6):
            newer = load.newer_rows(hours, hours.where(F.col("id") <= n), "ts")
            assert newer.count() == 5 - n
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_newer_rows_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    seen = events.where("ts < timestamp_ntz'2024-01-20'")
    newer = load.newer_rows(events, seen, "ts")
    assert "GreaterThan(ts,2024-01-1" in plan_of(newer)
    assert newer.count() + seen.count() == events.count()


def test_upsert_rules(spark):
    target = spark.createDataFrame([(1, "old", 5), (2, "newer", 9), (3, "only", 1), (4, "undated", None)], "k int, v string, o int")
    batch = spark.createDataFrame(
        [(1, "late", 4), (1, "wins", 6), (2, "stale", 8), (4, "dated", 1), (5, "new", 1), (5, "newest", 2), (3, "tie", 1),
         (6, "undated", None)], "k int, v string, o int")
    assert rows(load.upsert(target, batch, ["k"], "o")) == [
        (1, "wins", 6), (2, "newer", 9), (3, "tie", 1), (4, "dated", 1), (5, "newest", 2), (6, "undated", None)]


def test_upsert_keeps_an_undated_batch_row_out_of_a_dated_target(spark):
    target = spark.createDataFrame([(1, "dated", 5)], "k int, v string, o int")
    batch = spark.createDataFrame([(1, "undated", None)], "k int, v string, o int")
    assert rows(load.upsert(target, batch, ["k"], "o")) == [(1, "dated", 5)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 12), st.integers(0, 5)), st.lists(st.tuples(st.integers(0, 12), st.integers(0, 5)), max_size=25))
def test_upsert_property(spark, old, new):
    target = spark.createDataFrame([(k, "t", o) for k, o in old.items()], "k int, v string, o int")
    batch = spark.createDataFrame([(k, "b", o) for k, o in new], "k int, v string, o int")
    best = {k: ("t", o) for k, o in old.items()}
    for k, o in new:
        if k not in best or o >= best[k][1]:
            best[k] = ("b", o)
    merged = load.upsert(target, batch, ["k"], "o")
    assert rows(merged) == sorted(((k, v, o) for k, (v, o) in best.items()), key=repr)
    assert rows(load.upsert(merged, batch, ["k"], "o")) == rows(merged)


def test_versions_open_close_and_stay(spark):
    first = load.initial_versions(snapshot(spark, [(1, "a", 1), (2, "b", 1), (3, "c", 1)]), KEYS, TRACKED, "at")
    second = load.apply_versions(first, snapshot(spark, [(1, "a", 5), (2, "B", 5), (4, "d", 5)]), KEYS, TRACKED, "at")
    got = [(r["k"], r["s"], r["valid_from"], r["valid_to"], r["is_current"]) for r in second.orderBy("k", "valid_from").collect()]
    assert got == [(1, "a", 1, None, True), (2, "b", 1, 5, False), (2, "B", 5, None, True), (3, "c", 1, None, True),
                   (4, "d", 5, None, True)]
    third = load.apply_versions(second, snapshot(spark, [(2, "b", 9)]), KEYS, TRACKED, "at", close_missing=True, closed_at=F.lit(9))
    got = {(r["k"], r["s"], r["valid_from"]): r["valid_to"] for r in third.collect()}
    assert got == {(1, "a", 1): 9, (2, "b", 1): 5, (2, "B", 5): 9, (2, "b", 9): None, (3, "c", 1): 9, (4, "d", 5): 9}


def test_null_is_a_change(spark):
    first = load.initial_versions(snapshot(spark, [(1, None, 1)]), KEYS, TRACKED, "at")
    assert load.apply_versions(first, snapshot(spark, [(1, None, 2)]), KEYS, TRACKED, "at").count() == 1
    assert load.apply_versions(first, snapshot(spark, [(1, "", 2)]), KEYS, TRACKED, "at").count() == 2


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.integers(0, 9), st.sampled_from(["a", "b", None]), min_size=1), st.dictionaries(st.integers(0, 9), st.sampled_from(["a", "b", None])))
def test_versions_are_idempotent(spark, old, new):
    target = load.initial_versions(snapshot(spark, [(k, s, 1) for k, s in old.items()]), KEYS, TRACKED, "at")
    batch = snapshot(spark, [(k, s, 2) for k, s in new.items()])
    once = load.apply_versions(target, batch, KEYS, TRACKED, "at")
    assert rows(load.apply_versions(once, batch, KEYS, TRACKED, "at")) == rows(once)
    assert once.where("is_current").count() == len({*old, *new})


def test_late_rows_are_left_out_and_reported(spark):
    first = load.initial_versions(snapshot(spark, [(1, "a", 5), (2, "b", 5)]), KEYS, TRACKED, "at")
    batch = snapshot(spark, [(1, "x", 4), (2, "b", 4), (3, "n", 4)])
    assert rows(load.late_rows(first, batch, KEYS, TRACKED, "at")) == [(1, "x", 4)]
    applied = load.apply_versions(first, batch, KEYS, TRACKED, "at")
    assert sorted((r["k"], r["s"]) for r in applied.collect()) == [(1, "a"), (2, "b"), (3, "n")]


def test_history_of_a_feed(spark):
    feed = spark.createDataFrame([(1, "a", 1, 1), (1, "a", 2, 2), (1, "b", 3, 3), (1, "a", 3, 4), (1, None, 5, 5), (1, None, 6, 6), (2, None, 1, 7)],
                                 "k int, s string, ts int, id int")
    got = load.version_history(feed, ["k"], ["s"], ["ts", "id"])
    assert rows(got.select("k", "s", "valid_from", "valid_to", "is_current")) == sorted(
        [(1, "a", 1, 3, False), (1, "b", 3, 3, False), (1, "a", 3, 5, False), (1, None, 5, None, True), (2, None, 1, None, True)], key=repr)


def test_history_shuffles_once(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_of(load.version_history(events, ["user_id"], ["event_type"], ["ts", "event_id"]))
    assert plan.count("Exchange") == 1 and plan.count("Sort ") == 1


def test_upsert_of_a_small_batch_does_not_shuffle_the_target(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    batch = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    merged = load.upsert(orders, batch, ["o_orderkey"], "o_orderdate")
    merged.collect()
    kept = plan_of(merged).partition("Union")[2].partition("FileScan")[0]
    assert "LeftAnti, BuildRight" in kept and "Exchange" not in kept


def test_null_key_fails(spark):
    target = spark.createDataFrame([(1, "a", 1)], "k int, v string, o int")
    batch = spark.createDataFrame([(None, "b", 2)], "k int, v string, o int")
    with pytest.raises(Exception, match="NULL in key column k"):
        load.upsert(target, batch, ["k"], "o").collect()


def test_versions_shuffle_each_side_once(spark, tmp_path):
    customer = spark.read.parquet("/root/testdata/sf0.001/customer.parquet")
    snap = customer.select("c_custkey", "c_name", F.lit("2024-01-01").cast("timestamp_ntz").alias("at"))
    load.initial_versions(snap, ["c_custkey"], ["c_name"], "at").write.parquet(str(tmp_path / "versions"))
    target = spark.read.parquet(str(tmp_path / "versions"))  # whose history is read and not moved
    plan = plan_of(load.apply_versions(target, snap, ["c_custkey"], ["c_name"], "at"))
    assert plan.count("Exchange hashpartitioning") == 2
