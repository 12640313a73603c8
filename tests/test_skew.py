"""Hot keys: the salted and sliced ways must give what brute force gives."""

import bisect
import itertools
import random

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from conftest import plan_of, rows
from starload.operators.keys import highest, number_rows
from starload.operators.load import version_history
from starload.operators.lookup import lookup, lookup_as_of, unique_rows
from starload.operators.skew import FAN, SALT, SLICE, Scan, attach, hot_keys, keyed_scan, slice_hot_keys


def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.fixture()
def without_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    no_broadcast(spark)
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def facts(n=3000, seed=1):
    """A third of the rows on key 7, some NULL keys, some keys without a dimension row."""
    r = random.Random(seed)
    return [(i, 7 if i % 3 == 0 else None if i % 10 == 1 else r.randrange(200), r.randrange(10**6))
            for i in range(n)]


def test_hot_keys_finds_the_large_groups_only(spark):
    df = spark.createDataFrame(facts(), "id long, k long, v long")
    hot = {r["k"]: r[FAN] for r in hot_keys(df, ["k"], 100).collect()}
    assert set(hot) == {7, None}
    assert hot[7] >= 10
    assert hot_keys(df, ["k"], 5000) is None


def test_large_limits_are_judged_by_a_sample(spark):
    df = spark.range(400_000).select(F.when(F.col("id") % 4 == 0, 1).otherwise(F.col("id")).alias("k"))
    hot = hot_keys(df, ["k"], 40_000).collect()
    assert [(r["k"], r[FAN]) for r in hot] == [(1, 3)]


@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_join_equals_plain_join(spark, without_broadcast, how):
    data = facts()
    fact = spark.createDataFrame(data, "id long, k long, v long")
    known = {k: f"d{k}" for k in range(0, 150)}
    known[None] = "none"
    dim = spark.createDataFrame(list(known.items()), "k long, name string")
    salted = attach(fact, dim, ["k"], how, hot_rows=100)
    assert SALT in plan_of(salted)
    expected = []
    for i, k, v in data:
        name = known.get(k) if k is not None else None
        if name is not None or how == "left":
            expected.append((i, k, v, name))
    assert rows(salted) == sorted(expected, key=repr)
    assert rows(attach(fact, dim, ["k"], how, hot_rows=None)) == sorted(expected, key=repr)


def test_salted_join_spreads_the_hot_key(spark, without_broadcast):
    fact = spark.createDataFrame(facts(), "id long, k long, v long")
    dim = spark.createDataFrame([(k, k) for k in range(200)], "k long, d long")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = attach(fact, dim, ["k"], hot_rows=100)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 3000
    assert max(sizes) < 800  # the hot key alone has 1000 rows


def test_small_dimension_is_broadcast_without_counting(spark):
    fact = spark.range(1000).withColumn("k", F.col("id") % 3)
    dim = spark.range(2).select(F.col("id").alias("k"), F.lit("a").alias("name"))
    joined = attach(fact, dim, ["k"], hot_rows=10)
    assert "BroadcastHashJoin" in plan_of(joined) and SALT not in plan_of(joined)


def test_lookup_keeps_every_fact_and_fills_misses(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20), (3, None)], "id long, nk long")
    dim = spark.createDataFrame([(100, 10), (101, None)], "key long, nk long")
    found = lookup(fact, dim, [("nk", "nk")], {"dim_key": "key"})
    assert rows(found) == [(1, 10, 100), (2, 20, None), (3, None, None)]
    filled = lookup(fact, dim, [("nk", "nk")], {"dim_key": "key"}, unknown_key=-1)
    assert rows(filled) == [(1, 10, 100), (2, 20, -1), (3, None, -1)]


def test_lookup_in_a_dimension_made_from_the_fact_itself(spark):
    fact = spark.createDataFrame([(1, 10), (2, 20)], "id long, nk long")
    dim = fact.select("nk", F.col("id").alias("key"))
    assert rows(lookup(fact, dim, [("nk", "nk")], {"k": "key"})) == [(1, 10, 1), (2, 20, 2)]
    for hot_rows in (None, 0.5):
        assert rows(attach(fact, fact.select("nk"), ["nk"], hot_rows=hot_rows)) == [(1, 10), (2, 20)]
        own = fact.select("nk", "id").withColumnRenamed("id", "again")
        assert rows(attach(fact, own, ["nk"], hot_rows=hot_rows)) == [(1, 10, 1), (2, 20, 2)]


def test_duplicated_dimension_key_fails_when_verified(spark):
    fact = spark.createDataFrame([(1, 10)], "id long, nk long")
    dim = spark.createDataFrame([(100, 10), (101, 10)], "key long, nk long")
    with pytest.raises(Exception, match="more than one row"):
        lookup(fact, dim, [("nk", "nk")], {"k": "key"}, unique="verify").collect()
    assert rows(unique_rows(dim.where("key = 100"), ["nk"])) == [(100, 10)]


# --- scans --------------------------------------------------------------------------


def scan_brute(data):
    out = []
    for _, group in itertools.groupby(sorted(data, key=lambda r: (repr(r[0]), r[1])), key=lambda r: r[0]):
        group = list(group)
        latest = None
        for i, (k, o, v) in enumerate(group):
            latest = v if v is not None else latest
            out.append((k, o, v, group[i - 1][2] if i else None,
                        group[i + 1][2] if i + 1 < len(group) else None, latest))
    return sorted(out, key=repr)


def scans():
    return {"before": Scan("previous", F.col("v")), "after": Scan("next", F.col("v")),
            "latest": Scan("latest", F.col("v"))}


@pytest.mark.parametrize("hot_rows", [20, 10**6])
def test_keyed_scan_equals_brute_force(spark, hot_rows):
    r = random.Random(3)
    data = [(5 if i % 3 == 0 else None if i % 7 == 0 else r.randrange(40), i,
             r.randrange(100) if r.random() < 0.3 else None) for i in range(1500)]
    df = spark.createDataFrame(data, "k long, o long, v long")
    rows_ = slice_hot_keys(df, ["k"], ["o"], hot_rows)
    assert (SLICE in rows_.columns) == (hot_rows == 20)
    got = keyed_scan(rows_, ["k"], ["o"], scans()).drop(SLICE)
    assert rows(got) == scan_brute(data)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, None]), st.one_of(st.none(), st.integers(0, 3))),
                min_size=1, max_size=60), st.integers(1, 15))
def test_keyed_scan_property(spark, values, hot_rows):
    data = [(k, i, v) for i, (k, v) in enumerate(values)]
    df = spark.createDataFrame(data, "k long, o long, v long")
    got = keyed_scan(slice_hot_keys(df, ["k"], ["o"], hot_rows), ["k"], ["o"], scans()).drop(SLICE)
    assert rows(got) == scan_brute(data)


def test_history_and_as_of_lookup_with_a_hot_key(spark):
    r = random.Random(5)
    feed = [(9 if i % 3 == 0 else r.randrange(20), 10 * i, i, r.choice("abc")) for i in range(900)]
    df = spark.createDataFrame(feed, "k long, ts long, id long, s string")
    plain = version_history(df, ["k"], ["s"], ["ts", "id"])
    sliced = version_history(df, ["k"], ["s"], ["ts", "id"], hot_rows=25)
    assert rows(plain) == rows(sliced)

    versions = {}
    for v in plain.collect():
        versions.setdefault(v["k"], []).append((v["valid_from"], v["valid_to"], v["s"]))
    for v in versions.values():
        v.sort(key=lambda x: x[0])
    asked = [(i, 9 if i % 3 == 0 else r.randrange(25), r.randrange(9200)) for i in range(900)]
    expected = []
    for i, k, at in asked:
        own = versions.get(k, [])
        j = bisect.bisect_right([v[0] for v in own], at) - 1
        expected.append((i, k, at, own[j][2] if j >= 0 and (own[j][1] is None or at < own[j][1]) else None))
    fact = spark.createDataFrame(asked, "id long, k long, at long")
    for hot_rows in (25, 10**6):
        found = lookup_as_of(fact, plain, [("k", "k")], "at", {"state": "s"}, hot_rows=hot_rows)
        assert rows(found) == sorted(expected, key=repr)


def test_as_of_lookup_has_no_pairwise_join(spark):
    dim = spark.createDataFrame([(1, 0, 5, "a")], "k long, valid_from long, valid_to long, s string")
    fact = spark.createDataFrame([(1, 1, 3), (2, 1, 5), (3, None, 3)], "id long, k long, at long")
    found = lookup_as_of(fact, dim, [("k", "k")], "at", {"s": "s"}, unknown_key="?")
    assert rows(found) == [(1, 1, 3, "a"), (2, 1, 5, "?"), (3, None, 3, "?")]
    assert "Join" not in plan_of(found)


# --- numbering ----------------------------------------------------------------------


def test_numbering_equals_the_global_window(spark):
    df = spark.range(5000).select(F.when(F.col("id") != 77, F.md5(F.col("id").cast("string"))).alias("k"))
    numbered = number_rows(df, ["k"], "n")
    assert "SinglePartition" not in plan_of(numbered)
    window = df.withColumn("n", F.row_number().over(Window.orderBy(F.col("k").asc_nulls_last())).cast("bigint"))
    assert rows(numbered) == rows(window)


def test_numbering_spreads_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = number_rows(spark.range(10000).select(F.col("id").alias("k")), ["k"], "n")
        assert rows(numbered) == [tuple(x) for x in sorted(((k, k + 1) for k in range(10000)), key=repr)]
        assert len(numbered.select("n").inputFiles()) > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_numbering_of_nothing_and_after_a_maximum(spark):
    empty = spark.createDataFrame([], "k long")
    assert number_rows(empty, ["k"], "n").count() == 0
    used = spark.createDataFrame([(41,)], "n long")
    more = number_rows(spark.createDataFrame([(5,), (3,)], "k long"), ["k"], "n", after=highest(used, "n"))
    assert rows(more) == [(3, 42), (5, 43)]
    assert rows(number_rows(spark.createDataFrame([(5,)], "k long"), ["k"], "n",
                            after=highest(used.where("n < 0"), "n"))) == [(5, 1)]


def test_equal_order_values_are_numbered_the_same_every_time(spark):
    df = spark.range(3000).select(F.lit(1).alias("k"), F.col("id"))
    first = rows(number_rows(df, ["k"], "n"))
    assert sorted(r[2] for r in first) == list(range(1, 3001))
    assert rows(number_rows(df.repartition(5), ["k"], "n")) == first
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert len(number_rows(df, ["k"], "n").inputFiles()) > 4
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_settings_grow_with_the_input():
    from starload.settings import settings_for
    small, large = settings_for(10**9, 8), settings_for(100 * 10**12, 8000)
    assert small["spark.sql.shuffle.partitions"] == "24"
    assert 200_000 < int(large["spark.sql.shuffle.partitions"]) < 600_000
    assert int(large["spark.sql.files.maxPartitionBytes"]) > int(small["spark.sql.files.maxPartitionBytes"])
