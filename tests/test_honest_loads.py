"""Loads and checks on input that used to lose rows or pass without a word."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starload import spec as S
from starload.functions.registry import FunctionRegistry
from starload.operators import load, lookup, quality, runlog
from starload.plans.build import build
from starload.plans.load import LOG_TABLE, LoadRun, StepFailed
from starload.spec import BuildSpec, Call, ColumnMapping, Lookup, SpecError, TableSpec, column

T1 = datetime.datetime(2026, 1, 1)
KEYS, TRACKED = ["k"], ["s"]


def changes(spark, data):
    return spark.createDataFrame(data, "k int, s string, at int")


def test_winner_does_not_depend_on_the_partitions(spark):
    df = spark.createDataFrame([(1, f"v{i * 7 % 50:02d}", None if i % 3 else i % 5, 5) for i in range(50)], "k int, v string, w int, o int")
    got = {tuple(load.latest_rows(df.repartition(n), ["k"], ["o"]).first()) for n in (1, 2, 3, 8)}
    assert got == {(1, "v49", None, 5)}


def test_increment_takes_ties_and_missing_moments_once(spark):
    make = lambda *r: spark.createDataFrame(list(r), "id int, ts int")
    target = make((1, 5), (2, 9), (6, None))
    source = make((1, 5), (2, 9), (3, 9), (4, None), (5, 7), (6, None), (7, 11))
    keys = {"id": "id"}
    assert rows(load.newer_rows(source, target, "ts", keys=keys)) == [(3, 9), (4, None), (7, 11)]
    assert rows(load.older_rows(source, target, "ts", keys)) == [(5, 7)]
    both = target.union(load.newer_rows(source, target, "ts", keys=keys))
    assert load.newer_rows(source, both, "ts", keys=keys).count() == 0
    only_undated = make((6, None))
    assert rows(load.newer_rows(source, only_undated, "ts", keys=keys)) == [
        (1, 5), (2, 9), (3, 9), (4, None), (5, 7), (7, 11)]
    assert load.older_rows(source, only_undated, "ts", keys).count() == 0


def versions(df):
    return rows(df.select("k", "s", "valid_from", "valid_to", "is_current"))


def test_several_changes_of_a_key_in_one_batch(spark):
    first = load.initial_versions(changes(spark, [(1, "a", 0), (2, "x", 0), (3, "q", 5)]), KEYS, TRACKED, "at")
    batch = changes(spark, [(1, "b", 1), (1, "c", 2), (1, "c", 3), (2, "x", 4), (3, "old", 4), (4, "n", 1), (4, "m", 1)])
    second = load.apply_versions(first, batch, KEYS, TRACKED, "at")
    assert versions(second) == sorted([
        (1, "a", 0, 1, False), (1, "b", 1, 2, False), (1, "c", 2, None, True), (2, "x", 0, None, True),
        (3, "q", 5, None, True), (4, "n", 1, None, True)], key=repr)
    assert rows(load.late_rows(first, batch, KEYS, TRACKED, "at")) == [(3, "old", 4)]
    assert versions(load.apply_versions(second, changes(spark, [(1, "c", 9)]), KEYS, TRACKED, "at")) == versions(second)
    assert versions(load.initial_versions(changes(spark, [(1, "a", 0), (1, "a", 1), (1, "b", 2)]), KEYS, TRACKED, "at")) == [
        (1, "a", 0, 2, False), (1, "b", 2, None, True)]


def test_hot_keys_give_the_same_versions(spark):
    data = [(1, f"s{i // 3}", i) for i in range(90)] + [(k, "x", 1) for k in range(2, 9)]
    plain = load.initial_versions(changes(spark, data), KEYS, TRACKED, "at")
    assert versions(load.initial_versions(changes(spark, data), KEYS, TRACKED, "at", hot_rows=10)) == versions(plain)
    more = changes(spark, [(1, f"t{i // 2}", 100 + i) for i in range(60)])
    assert versions(load.apply_versions(plain, more, KEYS, TRACKED, "at", hot_rows=10)) == versions(
        load.apply_versions(plain, more, KEYS, TRACKED, "at"))


def test_only_new_versions_are_numbered(spark):
    target = load.initial_versions(changes(spark, [(1, "a", 0), (2, "b", 0)]), KEYS, TRACKED, "at").withColumn("key", F.col("k").cast("long"))
    batch = changes(spark, [(1, "a", 1), (2, "c", 1), (3, "d", 1), (2, "e", 2)]).withColumn("key", F.col("k") * 10 + F.col("at"))
    got = load.apply_versions(target, batch, KEYS, TRACKED, "at", generated=["key"])
    assert rows(got.select("k", "s", "key")) == [(1, "a", 1), (2, "b", 2), (2, "c", 3), (2, "e", 4), (3, "d", 5)]


def test_known_keys_stay_and_new_ones_have_no_gaps(spark):
    target = spark.range(1, 6).select(F.col("id").alias("k"), F.col("id").alias("key"))
    batch = spark.range(3, 10).select(F.col("id").alias("k"), (F.col("id") * 5).alias("key"))
    assert rows(load.keep_keys(batch, target, ["k"], ["key"])) == [(k, k if k < 6 else k) for k in range(3, 10)]


# --- lookups by validity --------------------------------------------------------------


def history(spark):
    return spark.sql("""SELECT * FROM VALUES (1, 'a', 0, 5), (1, 'b', 5, NULL), (2, 'c', 3, 6), (2, 'd', 8, 8), (NULL, 'n', 0, NULL)
                        AS t(k, s, valid_from, valid_to)""")


def test_small_versioned_dimension_moves_no_fact(spark):
    facts = spark.range(2000).select("id", (F.col("id") % 4).cast("int").alias("k"), (F.col("id") % 11).cast("int").alias("at"))
    found = lookup.lookup_as_of(facts, history(spark), [("k", "k")], "at", {"state": "s"}, unknown_key="?")
    found.collect()
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "Window" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        moved = lookup.lookup_as_of(facts, history(spark), [("k", "k")], "at", {"state": "s"}, unknown_key="?")
        assert "Window" in plan_of(moved) and rows(moved) == rows(found)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    expected = {0: "?", 1: {True: "a", False: "b"}, 2: "c"}
    for r in found.where("id < 40").collect():
        want = expected[1][r["at"] < 5] if r["k"] == 1 else "c" if r["k"] == 2 and 3 <= r["at"] < 6 else "?"
        assert r["state"] == want


def test_overlapping_versions_are_found(spark):
    assert lookup.overlapping_versions(history(spark), ["k"]).count() == 0
    two_open = history(spark).union(spark.createDataFrame([(1, "z", 7, None)], history(spark).schema))
    assert [r["k"] for r in lookup.overlapping_versions(two_open, ["k"]).collect()] == [1]


def test_build_refuses_a_dimension_that_repeats_its_key(spark):
    spec = BuildSpec(TableSpec("analytics", "f", (column("id", "BIGINT"), column("d", "INT"))), ("src",), (
        ColumnMapping("id", S.DIRECT, "id"), ColumnMapping("d", S.LOOKUP, lookup=Lookup("dim", "key", (("nk", "nk"),)))))
    source = spark.createDataFrame([(1, "a")], "id long, nk string")
    dim = spark.createDataFrame([(1, "a"), (2, "a")], "key int, nk string")
    with pytest.raises(Exception, match="more than one row"):
        build(spec, {"src": source}, {"dim": dim}).collect()
    assert build(spec, {"src": source}, {"dim": dim}, unique="trust").count() == 2


# --- runs ----------------------------------------------------------------------------

WORDS = TableSpec("raw", "words", (column("id", "BIGINT", pk=True), column("word", "TEXT")))
LOADED = BuildSpec(TableSpec("analytics", "words_loaded", (column("n", "BIGINT", pk=True), column("id", "BIGINT"), column("word", "TEXT"))),
                   ("words",), (ColumnMapping("n", S.GENERATED, order_by=("id",)), ColumnMapping("id", S.DIRECT, "id"),
                                ColumnMapping("word", S.DIRECT, "word")))


def words(warehouse, number=3):
    warehouse.replace(WORDS, warehouse.spark.range(number).select("id", F.lit("w").alias("word")))


def test_finished_steps_are_in_the_log_of_a_lost_run(warehouse):
    words(warehouse)
    run = LoadRun(warehouse, {"words": WORDS}, FunctionRegistry(), T1, "lost")
    run._step(LOADED, runlog.READ, lambda: run._read(LOADED))
    assert [r["stage"] for r in warehouse.table(LOG_TABLE).collect()] == ["read"]

    def without_text():
        raise ValueError
    with pytest.raises(StepFailed, match="ValueError"):
        run._step(LOADED, runlog.PROCESS, without_text)

    def two_lines():
        raise ValueError("one\ntwo")
    with pytest.raises(StepFailed):
        run._step(LOADED, runlog.WRITE, two_lines)
    assert [r["error_message"] for r in warehouse.table(LOG_TABLE).orderBy("seq").collect()] == [None, "ValueError", "one\ntwo"]


def test_a_failed_validation_is_logged(warehouse, monkeypatch):
    words(warehouse)
    run = LoadRun(warehouse, {"words": WORDS}, FunctionRegistry(), T1, "bad")

    def broken(specs):
        raise RuntimeError("no checks today")
    monkeypatch.setattr(run, "validate", broken)
    with pytest.raises(StepFailed, match="validate failed: no checks today"):
        run.run([LOADED])
    assert warehouse.table(LOG_TABLE).where("stage = 'validate' AND status = 'failure'").count() == 1


def test_interleaved_runs_do_not_delete_each_others_rows(warehouse):
    from starload.scratch import Workspace, materialise
    spark = warehouse.spark
    one, other = Workspace(spark), Workspace(spark)
    with one.active():
        mine = materialise(spark.range(3), "x")
        with other.active():
            theirs = materialise(spark.range(4), "x")
    other.close()
    assert mine.count() == 3 and len(one.paths) == 1
    with pytest.raises(Exception):
        theirs.count()
    one.close()
    words(warehouse, 50)
    specs = [BuildSpec(TableSpec("analytics", f"loaded_{n}", LOADED.target.columns), ("words",), LOADED.columns) for n in "ab"]
    runs = [LoadRun(warehouse, {"words": WORDS}, FunctionRegistry(), T1, n) for n in "ab"]
    batch = []
    for run, spec in zip(runs, specs):
        run._step(spec, runlog.READ, lambda run=run, spec=spec: run._read(spec))
        with run.workspace.active():
            batch.append(materialise(warehouse.table(WORDS), "batch"))
    runs[1].run([specs[1]], validate=False)
    assert batch[0].count() == 50
    runs[0].run([specs[0]], validate=False)
    assert [warehouse.table(s.target).count() for s in specs] == [50, 50]


def test_partitioned_reload_never_drops_the_table(warehouse, monkeypatch):
    spec = TableSpec("analytics", "parts", (column("id", "INT"), column("y", "INT")), ("y",))
    make = lambda *r: warehouse.spark.createDataFrame(list(r), "id int, y int")
    warehouse.replace(spec, make((1, 2020), (2, 2021)))
    seen, sql = [], warehouse.spark.sql
    monkeypatch.setattr(warehouse.spark, "sql", lambda text, *a, **k: seen.append(text) or sql(text, *a, **k))
    warehouse.replace(spec, make((3, 2021), (4, 2022)))
    assert rows(warehouse.table(spec)) == [(3, 2021), (4, 2022)]
    assert not any(text.startswith(f"DROP TABLE {warehouse.name(spec)}") for text in seen)
    assert not any("DESCRIBE" in text for text in seen)


# --- checks and declarations ------------------------------------------------------------


def test_keys_of_other_runs_are_not_used_across_runs():
    from starload.plans.reconcile import choose_correlation
    source = TableSpec("raw", "src", (column("id", "INT", pk=True),))
    nested = ColumnMapping("dk", S.UDF, udf=Call("udf_generate_dk", (Call("udf_calculate_patient_bk", ("id",)), S.RUN_TIMESTAMP)))
    spec = BuildSpec(TableSpec("analytics", "t", (column("dk", "TEXT"),)), ("src",), (nested,))
    assert choose_correlation(spec, source) is not None and choose_correlation(spec, source, across_runs=True) is None


def test_drift_shuffles_once_and_sees_multiplicity(spark):
    make = lambda *r: spark.createDataFrame(list(r), "k int, v string")
    before, after = make((1, "a"), (1, "a"), (2, "x"), (3, None), (5, "s")), make((1, "b"), (1, "b"), (2, "x"), (3, ""), (4, "n"), (5, "s"), (5, "s"))
    found = quality.drift(before, after, ["k"], ["v"])
    assert rows(found) == [(1, "hash mismatch"), (3, "hash mismatch"), (4, "added"), (5, "hash mismatch")]
    assert plan_of(found).count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("declared, stored", [
    ("TINYINT", "tinyint"), ("INT2", "smallint"), ("INT4", "int"), ("INT8", "bigint"), ("SERIAL", "int"), ("BIGSERIAL", "bigint"),
    ("FLOAT4", "float"), ("FLOAT8", "double"), ("double  precision", "double"), ("REAL", "float"), ("BYTEA", "binary"),
    ("BOOL", "boolean"), ("CHAR(3)", "string"), ("TIMESTAMP WITHOUT TIME ZONE", "timestamp_ntz"),
    ("TIMESTAMP(6) WITH TIME ZONE", "timestamp"), ("timestamp(3)", "timestamp_ntz"), ("JSONB", "string"), ("NUMERIC", "decimal(38,18)"),
    ("DECIMAL( 9 , 2 )", "decimal(9,2)"),
])
def test_usual_spellings(declared, stored):
    assert column("c", declared).spark_type.simpleString() == stored


@pytest.mark.parametrize("declared", ["GEOMETRY", "MONEY[]", "NUMERIC(a)"])
def test_other_spellings_are_refused(declared):
    with pytest.raises(SpecError):
        column("c", declared).spark_type


def test_numeric_without_precision_does_not_round(spark):
    value = spark.sql("SELECT '1.123456789012345' AS v").select(F.col("v").cast(column("c", "NUMERIC").spark_type)).first()[0]
    assert str(value).startswith("1.123456789012345")


def test_join_of_an_unknown_table_is_refused():
    with pytest.raises(SpecError, match="not source tables"):
        BuildSpec(TableSpec("analytics", "t", (column("id", "INT"),)), ("a",), (ColumnMapping("id", S.DIRECT, "id"),),
                  joins=(S.Join("b", "a.id = b.id"),))
