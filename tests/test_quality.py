import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starload import spec as S
from starload.functions import library as lib
from starload.operators import quality as Q
from starload.plans import reconcile as R
from starload.spec import BuildSpec, Call, ColumnMapping, TableSpec, column


def brief(report):
    return sorted((r["check_id"], r["status"], r["n"], r["detail"]) for r in report.collect())


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_row_count(spark):
    a, b = spark.range(5), spark.range(4)
    assert brief(Q.check_row_count("t", a, a)) == [("D-rowcount-t", "PASS", 0, "staging=5, target=5")]
    assert brief(Q.check_row_count("t", a, b)) == [("D-rowcount-t", "FAIL", 1, "staging=5, target=4")]
    assert brief(Q.check_row_count("t", a, a, filtered=True)) == [(
        "D-rowcount-t", "WARN", 0, "staging=5, target=5 (buildspec declares filter(s), exact match not asserted)")]


def test_unique(spark):
    df = frame(spark, [(1, None), (1, None), (2, 1), (2, 2), (3, 3), (3, 3), (3, 3)], "a int, b int")
    assert brief(Q.check_unique("t", df, ["a", "b"])) == [
        ("D-duplicates-t", "FAIL", 2, "2 duplicate primary-key group(s) on (a, b)")]
    assert brief(Q.check_unique("t", df.where("a = 2"), ["a", "b"])) == [("D-duplicates-t", "PASS", 0, "(a, b) unique")]
    assert brief(Q.check_unique("t", df.where("a = 9"), ["a", "b"])) == []
    assert brief(Q.check_unique("t", df, ["a"], grain=True)) == [
        ("D-grain-t", "FAIL", 3, "3 group(s) with more than one row on (a)")]


def test_not_null_in_one_scan(spark, tmp_path):
    frame(spark, [(1, None), (None, None)], "a int, b string").write.parquet(str(tmp_path / "x"))
    df = spark.read.parquet(str(tmp_path / "x"))
    report = Q.check_not_null("t", df, ["a", "b"])
    assert brief(report) == [("D-notnull-t.a", "FAIL", 1, "1 unexpected NULL(s) in NOT NULL column"),
                             ("D-notnull-t.b", "FAIL", 2, "2 unexpected NULL(s) in NOT NULL column")]
    assert plan_of(report).count("FileScan") == 1
    assert brief(Q.check_not_null("t", df.where("a = 1"), ["a"])) == [("D-notnull-t.a", "PASS", 0, "no NULLs")]


def test_foreign_key(spark):
    child = frame(spark, [(1,), (1,), (9,), (9,), (None,)], "fk int")
    parent = frame(spark, [(1,), (1,), (2,)], "id int")
    assert brief(Q.check_foreign_key("c", child, "fk", parent, "p", "id")) == [
        ("D-fk-c.fk", "FAIL", 2, "2 row(s) with fk not found in p.id")]
    assert brief(Q.check_foreign_key("c", child.where("fk = 1"), "fk", parent, "p", "id")) == [
        ("D-fk-c.fk", "PASS", 0, "all fk values resolve to p.id")]
    spec = TableSpec("analytics", "c", (column("fk", "INT", fk=S.ForeignKey("p", "id", enforced=False)),))
    assert [c[1] for c in brief(Q.check_table(spec, child, {"p": parent}))] == ["WARN"]
    plan = plan_of(Q.check_foreign_key("c", child, "fk", parent, "p", "id"))
    assert "LeftAnti" in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_width_and_parsed(spark):
    df = frame(spark, [("DOC-0001|TNMC-CARD-1001",), ("D|1",), (None,)], "bk string")
    assert brief(Q.check_width("d", df, {"bk": 20})) == [
        ("D-width-d.bk", "WARN", 1, "1 value(s) longer than 20, longest 23")]
    assert brief(Q.check_width("d", df, {"bk": 50})) == [("D-width-d.bk", "PASS", 0, "longest value 23 of 50")]
    dates = frame(spark, [("2024-01-01",), ("soon",), (None,)], "d string")
    raw = F.col("d")
    assert brief(Q.check_parsed("t", dates, {"d": (raw, lib.parse_date(raw))})) == [
        ("D-parse-t.d", "WARN", 1, "1 value(s) could not be parsed")]


# --- schema -------------------------------------------------------------------------


def declared(*columns, namespace="analytics"):
    return TableSpec(namespace, "t", tuple(columns))


def test_schema(spark):
    live = frame(spark, [(1, "abc", None)], "ID bigint, Name string, d decimal(5,1)")
    spec = declared(column("id", "BIGINT"), column("name", "VARCHAR(2)"), column("d", "NUMERIC(9,2)"),
                    column("gone", "TEXT"), column("x", "GEOMETRY"))
    got = {i: (s, d) for i, s, _, d in brief(Q.check_schema(spec, live, spark))}
    assert got == {
        "S-target-t.id": ("PASS", "matches live schema"),
        "S-target-t.name": ("FAIL", "type mismatch: declared 'VARCHAR(2)', live 'varchar(3)'"),
        "S-target-t.d": ("PASS", "matches live schema"),
        "S-target-t.gone": ("FAIL", "column 'gone' missing from live table 't'"),
        "S-target-t.x": ("FAIL", "column 'x' missing from live table 't'"),
    }
    assert brief(Q.check_schema(spec, None, spark)) == [
        ("S-target-t", "FAIL", 1, "table 't' not found in live target database")]
    wrong = declared(column("id", "INT"), column("name", "DATE"), column("d", "MONEY"))
    assert [s for _, s, _, _ in brief(Q.check_schema(wrong, live, spark))] == ["PASS", "FAIL", "FAIL"]


def test_schema_knows_the_length_of_table_columns(spark, warehouse):
    made = TableSpec("analytics", "t", (column("name", "VARCHAR(5)"),))
    warehouse.create_table(made)
    live = warehouse.table(made)
    assert brief(Q.check_schema(made, live, spark))[0][1] == "PASS"
    assert brief(Q.check_schema(declared(column("name", "VARCHAR(6)")), live, spark))[0][1] == "FAIL"


# --- recomputation ------------------------------------------------------------------

SOURCE = TableSpec("raw", "src", (column("id", "INT", pk=True), column("gender", "TEXT"), column("a", "TEXT"), column("b", "TEXT")))


def build_spec(*mappings, kinds=None):
    types = kinds or {}
    return BuildSpec(TableSpec("analytics", "t", tuple(column(m.target_column, types.get(m.target_column, "TEXT"))
                                                       for m in mappings)), ("src",), mappings)


NAME = ColumnMapping("name", S.UDF, ("a", "b"), udf="udf_full_name")
ID = ColumnMapping("pid", S.DIRECT, "id")
GENDER = ColumnMapping("gender", S.DIRECT, "gender")
BK = ColumnMapping("bk", S.UDF, "id", udf="udf_calculate_patient_bk")


def test_correlation_key_choice():
    assert R.choose_correlation(build_spec(GENDER, NAME, ID), SOURCE).target_columns == ("pid",)
    assert R.choose_correlation(build_spec(GENDER, NAME, BK), SOURCE).target_columns == ("bk",)
    assert R.choose_correlation(build_spec(GENDER, NAME), SOURCE) is None
    composite = TableSpec("raw", "src", (column("id", "INT", pk=True), column("a", "TEXT", pk=True), column("b", "TEXT")))
    both = ColumnMapping("both", S.UDF, ("id", "a"), udf="udf_calculate_doctor_bk")
    a = ColumnMapping("a_copy", S.DIRECT, "a")
    assert R.choose_correlation(build_spec(ID, a, NAME), composite).target_columns == ("pid", "a_copy")
    assert R.choose_correlation(build_spec(both, NAME), composite).target_columns == ("both",)
    assert R.choose_correlation(build_spec(ID, NAME), composite) is None
    nested = ColumnMapping("dk", S.UDF, udf=Call("udf_generate_dk", (Call("udf_calculate_patient_bk", ("id",)), S.RUN_TIMESTAMP)))
    assert R.choose_correlation(build_spec(nested), SOURCE).target_columns == ("dk",)


def test_recompute(spark):
    source = frame(spark, [(1, "F", "A", "B"), (2, "F", "C", None), (3, "F", None, None), (4, "M", "D", "E")], "id int, gender string, a string, b string")
    spec = build_spec(ID, NAME, kinds={"pid": "INT"})
    target = frame(spark, [(1, "A B"), (2, "wrong"), (3, None), (99, "no source")], "pid int, name string")
    assert brief(R.check_recomputed(spec, SOURCE, target, {"src": source})) == [
        ("D-udf-t.name", "FAIL", 2, "2/3 row(s) mismatch re-invoking udf_full_name(...); "
         "1 row(s) without one source row of their key not compared")]
    good = frame(spark, [(1, "A B"), (2, "C"), (3, "")], "pid int, name string")
    assert brief(R.check_recomputed(spec, SOURCE, good, {"src": source})) == [
        ("D-udf-t.name", "PASS", 0, "0/3 row(s) mismatch re-invoking udf_full_name(...)")]
    assert brief(R.check_recomputed(spec, SOURCE, good.where("pid > 9"), {"src": source})) == [
        ("D-udf-t.name", "WARN", 0, "no rows to check")]


def test_recompute_by_computed_key_with_a_shared_gender(spark):
    """Rows that agree in a column of few values must not be compared with each other."""
    source = frame(spark, [(i, "F", f"n{i}", "x") for i in range(20)], "id int, gender string, a string, b string")
    spec = build_spec(GENDER, BK, NAME)
    target = frame(spark, [("F", str(i), f"n{i} x") for i in range(20)], "gender string, bk string, name string")
    assert [c[1:3] for c in brief(R.check_recomputed(spec, SOURCE, target, {"src": source}))] == [("PASS", 0), ("PASS", 0)]
    assert brief(R.check_recomputed(build_spec(GENDER, NAME), SOURCE, target, {"src": source}))[0][1] == "WARN"


def test_recompute_skips_ambiguous_sources_and_does_not_multiply(spark):
    source = frame(spark, [(1, "F", "A", "B")] * 50 + [(2, "F", "C", "D")], "id int, gender string, a string, b string")
    target = frame(spark, [(1, "A B")] * 50 + [(2, "C D")] * 2, "pid int, name string")
    spec = build_spec(ID, NAME, kinds={"pid": "INT"})
    assert brief(R.check_recomputed(spec, SOURCE, target, {"src": source})) == [
        ("D-udf-t.name", "WARN", 0, "0/2 row(s) mismatch re-invoking udf_full_name(...); "
         "50 row(s) without one source row of their key not compared")]


def test_a_null_key_identifies_no_source_row(spark):
    source = frame(spark, [(None, "F", "A", "B")], "id int, gender string, a string, b string")
    target = frame(spark, [(None, "A B")], "pid int, name string")
    got = R.check_recomputed(build_spec(ID, NAME, kinds={"pid": "INT"}), SOURCE, target, {"src": source})
    assert brief(got)[0][1:3] == ("WARN", 0)


# --- drift and reports --------------------------------------------------------------


def test_drift(spark):
    before = frame(spark, [(1, "a"), (2, "b"), (3, None), (5, "x"), (5, "x"), (6, "p"), (6, "q")], "k int, v string")
    after = frame(spark, [(1, "a"), (2, "B"), (4, "d"), (3, ""), (5, "x"), (6, "q"), (6, "p")], "k int, v string")
    assert rows(Q.drift(before, after, ["k"], ["v"])) == [
        (2, "hash mismatch"), (3, "hash mismatch"), (4, "added"), (5, "hash mismatch")]
    assert brief(Q.check_drift("t", before, before, ["k"], ["v"])) == [("D-drift-t", "PASS", 0, "no drift")]
    assert brief(Q.check_drift("t", before, after, ["k"], ["v"])) == [
        ("D-drift-t", "WARN", 4, "0 missing, 1 added, 3 hash mismatch")]
    assert "Join" not in plan_of(Q.drift(before, after, ["k"], ["v"]))
    a = frame(spark, [(1, None, "a"), (2, "a", "b")], "k int, v string, w string")
    b = frame(spark, [(1, "a", None), (2, "b", "a")], "k int, v string, w string")
    assert rows(Q.drift(a, b, ["k"], ["v", "w"])) == [(1, "hash mismatch"), (2, "hash mismatch")]


@pytest.mark.parametrize("statuses, expected", [
    (["PASS", "WARN", "FAIL"], "FAIL"), (["PASS", "WARN"], "WARN"), (["PASS"], "PASS"), ([], "PASS")])
def test_roll_up(spark, statuses, expected):
    report = frame(spark, [(f"D-rowcount-t{i}", "data", s, "", 0) for i, s in enumerate(statuses)], Q.REPORT)
    top = Q.roll_up(report).first()
    assert top["status"] == expected and top["checks"] == len(statuses)
    assert Q.exit_code(report) == int(expected == "FAIL")


def test_table_of_check(spark):
    report = frame(spark, [("D-notnull-dim_a.b", "data", "PASS", "", 0), ("D-rowcount-dim_a", "data", "FAIL", "", 1)], Q.REPORT)
    report = report.withColumn("table", Q.table_of_check(F.col("check_id")))
    assert rows(Q.roll_up(report, ["table"])) == [("dim_a", "FAIL", 2, 1, 0, 1)]
    assert rows(Q.summarise(report)) == [("data", "FAIL", 1), ("data", "PASS", 1)]
