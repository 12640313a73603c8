"""Records that do not fit, values too long for their column, joins without an equality, equal rows and hot keys."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starload import spec as S
from starload.functions.registry import FunctionRegistry
from starload.operators import keys, skew
from starload.plans import build as builder
from starload.plans.ingest import ingest
from starload.plans.load import LOG_TABLE, LoadRun, StepFailed
from starload.spec import BuildSpec, ColumnMapping, Join, Lookup, SpecError, TableSpec, column

PEOPLE = TableSpec("raw", "people", (column("id", "INT", pk=True), column("name", "TEXT"), column("born", "DATE")))


def test_rejected_records_are_kept_with_file_and_text(warehouse, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text("id;name;born\n1;Ann;2001-02-03\nx;Bob;2001-02-03\n3;Cay;yesterday\n")
    (folder / "b.csv").write_text("id;name;born\n4;Dee;\n5;Eve\n")
    report = ingest(warehouse, PEOPLE, str(folder), "csv", header="true", sep=";")
    assert rows(warehouse.table(PEOPLE)) == [(1, "Ann", datetime.date(2001, 2, 3)), (4, "Dee", None)]
    found = warehouse.table("staging.rejected_people")
    assert {(r["file"].rpartition("/")[2], r["text"]) for r in found.collect()} == {
        ("a.csv", "x;Bob;2001-02-03"), ("a.csv", "3;Cay;yesterday"), ("b.csv", "5;Eve")}
    assert [tuple(r) for r in report.collect()] == [("D-rejected-people", "data", "WARN", "3 record(s) could not be read", 3)]
    (folder / "c.json").write_text('{"id": 6, "name": "Fay"}\n{"id": "seven"}\nnot json\n')
    ingest(warehouse, PEOPLE, str(folder / "c.json"), "json", add=True)
    assert [r[0] for r in rows(warehouse.table(PEOPLE))] == [1, 4, 6]
    assert warehouse.table("staging.rejected_people").count() == 2


def test_all_records_fit_and_a_run_reports_it(warehouse, tmp_path):
    (tmp_path / "p.csv").write_text("1,Ann,2001-02-03\n")
    ingest(warehouse, PEOPLE, str(tmp_path / "p.csv"), "csv")
    spec = BuildSpec(TableSpec("analytics", "p", (column("id", "INT", pk=True),)), ("people",), (ColumnMapping("id", S.DIRECT, "id"),))
    report = LoadRun(warehouse, {"people": PEOPLE}, FunctionRegistry(), datetime.datetime(2025, 1, 1), "r").run([spec])
    assert report.where("check_id = 'D-rejected-people'").first()["detail"] == "all records read"


def test_a_value_too_long_for_its_column_is_told_before_the_write(warehouse):
    warehouse.replace(PEOPLE, warehouse.spark.createDataFrame([(1, "Annabel", None), (2, "Bo", None)], "id int, name string, born date"))
    spec = BuildSpec(TableSpec("analytics", "short", (column("id", "INT", pk=True), column("name", "VARCHAR(4)"))), ("people",),
                     (ColumnMapping("id", S.DIRECT, "id"), ColumnMapping("name", S.UDF, ("name", "name"), udf="udf_full_name")))
    with pytest.raises(StepFailed, match=r"D-width-short.name: 2 value\(s\) longer than 4, longest 15"):
        LoadRun(warehouse, {"people": PEOPLE}, FunctionRegistry(), datetime.datetime(2025, 1, 1), "r").run([spec])
    assert warehouse.table(LOG_TABLE).where("status = 'failure'").first()["stage"] == "process"


def test_successful_checks_are_logged(warehouse):
    warehouse.replace(PEOPLE, warehouse.spark.createDataFrame([(1, "Ann", None)], "id int, name string, born date"))
    spec = BuildSpec(TableSpec("analytics", "p", (column("id", "INT", pk=True),)), ("people",), (ColumnMapping("id", S.DIRECT, "id"),))
    LoadRun(warehouse, {"people": PEOPLE}, FunctionRegistry(), datetime.datetime(2025, 1, 1), "r").run([spec])
    assert rows(warehouse.table(LOG_TABLE).where("stage = 'validate'").select("status", "seq")) == [("success", 4)]


# --- joins ------------------------------------------------------------------------------


@pytest.mark.parametrize("on", ["a.x < b.y", "a.x = b.y OR true", "a.x = 3", "a.x = a.y", "x = y"])
def test_a_join_without_an_equality_is_refused(on):
    with pytest.raises(SpecError, match="no equality"):
        Join("raw.b", on)


def test_equalities_of_a_join():
    join = Join("b", "(b.y = a.`x`) and a.k <=> b.k AND b.flag = 'Y'")
    assert join.equalities == [(("a", "x"), ("b", "y")), (("a", "k"), ("b", "k"))]


FACT = TableSpec("analytics", "f", (column("id", "INT"), column("k1", "INT"), column("k2", "INT"), column("word", "TEXT")))
SPEC = BuildSpec(
    FACT, ("base", "other"),
    (ColumnMapping("id", S.DIRECT, "id"), ColumnMapping("word", S.DIRECT, "word", source_table="other"),
     ColumnMapping("k1", S.LOOKUP, lookup=Lookup("d1", "key", (("a", "nk"),))),
     ColumnMapping("k2", S.LOOKUP, lookup=Lookup("d2", "key", (("b", "nk"),)))),
    joins=(Join("other", "base.a = other.a AND other.a > 0"),))


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def sides(spark):
    base = spark.range(6000).selectExpr("CAST(id AS INT) AS id", "CAST(IF(id % 3 = 0, 7, id % 100) AS INT) AS a",
                                        "CAST(IF(id % 2 = 0, 1, id) AS INT) AS b")
    other = spark.range(50).selectExpr("CAST(id AS INT) AS a", "concat('w', id) AS word").union(
        spark.sql("SELECT 7, 'again'"))
    dim = lambda n: spark.range(n).selectExpr("CAST(id AS INT) AS nk", "CAST(id * 10 AS INT) AS key")
    return {"base": base, "other": other}, {"d1": dim(60), "d2": dim(3000)}


def test_hot_keys_of_all_lookups_and_joins_are_counted_together(spark, no_broadcast, monkeypatch):
    sources, dims = sides(spark)
    plain = rows(builder.build(SPEC, sources, dims, hot_rows=None))
    asked, real = [], skew.hot_keys_of_all

    def counted(df, sets, hot_rows):
        asked.append([list(s) for s in sets])
        return real(df, sets, 1000)
    monkeypatch.setattr(builder, "hot_keys_of_all", counted)
    monkeypatch.setattr(skew, "hot_keys", lambda *a: pytest.fail("a second count"))
    cut = builder.build(SPEC, sources, dims, unique="trust")
    assert rows(cut) == plain
    assert asked == [[["a"]], [["_k1_nk0"], ["_k2_nk0"]]]  # one count for the joins, one for the lookups
    text = plan_of(cut)
    assert "_salt" in text and "_salt_l" in text


def test_grouping_sets_find_what_single_counts_find(spark):
    base = sides(spark)[0]["base"].withColumn("n", F.when(F.col("id") % 4 == 0, F.lit(None)).otherwise(F.col("b")))
    sets = [["a"], ["b"], ["a", "b"], ["n"], ["id"], ["a"]]
    for together, keys_ in zip(skew.hot_keys_of_all(base, sets, 800), sets):
        alone = skew.hot_keys(base, keys_, 800)
        assert (together is None) == (alone is None)
        if alone is not None:
            assert rows(together) == rows(alone)


# --- rows that are equal altogether -------------------------------------------------------


@pytest.fixture()
def small_ranges(spark):
    """Ranges as they are cut, not joined again because a test has few rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_rows_lie_in_several_ranges(spark, small_ranges):
    df = spark.range(0, 20_000, 1, 8).selectExpr("'same' AS a", "1 AS b")
    numbered = keys.number_rows(df, ["a"], "number")
    assert sorted(r.number for r in numbered.select("number").collect()) == list(range(1, 20_001))
    placed = keys.position_rows(df, ["a"])
    ranges = placed.groupBy(F.shiftright("_position", 33).alias("range")).count().collect()
    assert len(ranges) > 1 and max(r["count"] for r in ranges) < 10_000


def test_order_of_equal_orders_is_the_same_whatever_the_partitions(spark):
    df = spark.range(3000).selectExpr("id % 5 AS a", "id % 50 AS b")
    one, other = (keys.number_rows(df.repartition(n), ["a"], "number").select("a", "b", "number") for n in (3, 11))
    assert rows(one) == rows(other)


def test_equal_rows_get_several_salts(spark, no_broadcast, tmp_path):
    path = str(tmp_path / "staged")
    spark.range(0, 20_000, 1, 4).selectExpr("7 AS _k1_nk0").write.parquet(path)
    staged = spark.read.parquet(path).withColumn(skew.PLACE, F.xxhash64("_metadata.file_path", "_metadata.row_index"))
    dim = spark.range(10).selectExpr("CAST(id AS INT) AS _k1_nk0", "id * 10 AS key")
    hot = skew.hot_keys(staged, ["_k1_nk0"], 2000)
    joined = skew.salted_join(staged, dim, ["_k1_nk0"], hot)
    parts = joined.groupBy(F.spark_partition_id()).count().collect()
    assert joined.count() == 20_000 and joined.where("key = 70").count() == 20_000
    assert "hashpartitioning(_k1_nk0" in plan_of(joined) and len(parts) >= 1
    salts = joined._jdf.queryExecution().analyzed().toString()
    assert "xxhash64(_place" in salts
