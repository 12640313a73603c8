"""Whole runs on a small clinic: namespaces, strategies, report and log."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from starload import spec as S
from starload.functions.registry import FunctionRegistry
from starload.operators import runlog
from starload.operators.quality import exit_code, roll_up
from starload.plans.load import EVENT_TABLE, LOG_TABLE, REPORT_TABLE, LoadRun, StepFailed
from starload.sources import readers
from starload.spec import BuildSpec, Call, ColumnMapping, Lookup, TableSpec, column

T1, T2 = datetime.datetime(2026, 1, 1), datetime.datetime(2026, 2, 1)

PERSON = TableSpec("raw", "person", (
    column("id", "TEXT", pk=True), column("first", "TEXT"), column("last", "TEXT"), column("born", "TEXT"),
    column("email", "TEXT"), column("active", "VARCHAR(1)")))
VISIT = TableSpec("raw", "visit", (
    column("visit_id", "INT", pk=True), column("person_id", "TEXT"), column("day", "DATE"), column("fee", "NUMERIC(10,2)")))
SOURCES = {t.name: t for t in (PERSON, VISIT)}

PEOPLE = [("P1", " Anne", "Lee", "1985-04-12", "A@X.IN ", "Y"), ("P2", "José", None, "bad", None, "n"),
          ("P3", "Anne", "Lee", "1985-04-12", "", "?")]
VISITS = [(1, "P1", datetime.date(2026, 1, 1), 10.5), (2, "P2", datetime.date(2026, 1, 2), 20.0),
          (3, "P9", datetime.date(2026, 1, 2), 5.0)]

DIM_PERSON = BuildSpec(
    TableSpec("analytics", "dim_person", (
        column("person_key", "BIGINT", pk=True), column("person_bk", "VARCHAR(10)", nullable=False),
        column("full_name", "VARCHAR(200)"), column("born", "DATE"), column("email", "VARCHAR(50)"),
        column("is_active", "BOOLEAN"))),
    ("person",),
    (ColumnMapping("person_key", S.GENERATED, order_by=("id",)),
     ColumnMapping("person_bk", S.UDF, "id", udf="udf_calculate_patient_bk"),
     ColumnMapping("full_name", S.UDF, ("first", "last"), udf="udf_full_name"),
     ColumnMapping("born", S.UDF, "born", udf="udf_parse_date"),
     ColumnMapping("email", S.UDF, "email", udf="udf_clean_email"),
     ColumnMapping("is_active", S.UDF, "active", udf="udf_flag_to_boolean")))

FACT_VISIT = BuildSpec(
    TableSpec("analytics", "fact_visit", (
        column("visit_key", "BIGINT", pk=True), column("visit_id", "INT"),
        column("person_key", "BIGINT", nullable=False, fk=("dim_person", "person_key")), column("fee", "NUMERIC(10,2)"))),
    ("visit",),
    (ColumnMapping("visit_key", S.GENERATED, order_by=("visit_id",)), ColumnMapping("visit_id", S.DIRECT, "visit_id"),
     ColumnMapping("person_key", S.LOOKUP, lookup=Lookup("dim_person", "person_key", (("person_id", "person_bk"),))),
     ColumnMapping("fee", S.DIRECT, "fee")))


def load_raw(warehouse, people=PEOPLE, visits=VISITS):
    spark = warehouse.spark
    people = spark.createDataFrame(people, "id string, first string, last string, born string, email string, active string")
    visits = spark.createDataFrame(visits, "visit_id int, person_id string, day date, fee double")
    warehouse.replace(PERSON, readers.typed(people, PERSON))
    warehouse.replace(VISIT, readers.typed(visits, VISIT))


def new_run(warehouse, at=T1, name="r1"):
    return LoadRun(warehouse, SOURCES, FunctionRegistry(), at, name)


def test_full_load(warehouse):
    load_raw(warehouse)
    report = new_run(warehouse).run([DIM_PERSON, FACT_VISIT])
    assert rows(warehouse.table(DIM_PERSON.target)) == [
        (1, "P1", "Anne Lee", datetime.date(1985, 4, 12), "a@x.in", True), (2, "P2", "José", None, None, False),
        (3, "P3", "Anne Lee", datetime.date(1985, 4, 12), None, None)]
    assert [(r[1], r[2]) for r in rows(warehouse.table(FACT_VISIT.target))] == [(1, 1), (2, 2), (3, None)]
    status = {r["check_id"]: r["status"] for r in report.collect()}
    failed = {k for k, v in status.items() if v != "PASS"}
    assert failed == {"D-notnull-fact_visit.person_key", "D-parse-dim_person.born"}
    assert status["D-parse-dim_person.born"] == "WARN"
    assert status["D-udf-dim_person.full_name"] == "PASS" and status["S-source-person.active"] == "PASS"
    assert roll_up(report).first()["status"] == "FAIL" and exit_code(report) == 1
    log = warehouse.table(LOG_TABLE)
    assert [(r["table"], r["stage"], r["rows_affected"]) for r in log.orderBy("seq").collect()] == [
        ("dim_person", "read", 3), ("dim_person", "process", None), ("dim_person", "write", 3),
        ("fact_visit", "read", 3), ("fact_visit", "process", None), ("fact_visit", "write", 3), ("fact_visit", "validate", None)]
    assert rows(runlog.run_status(log)) == [("r1", "PASS", "6 step(s) completed successfully", 6, 0)]
    event = warehouse.table(EVENT_TABLE).first()
    assert (event["run_id"], event["steps"], event["validation"], event["checks"]) == ("r1", 6, "FAIL", report.count())


def test_rerun_gives_the_same_rows(warehouse):
    load_raw(warehouse)
    new_run(warehouse).run([DIM_PERSON, FACT_VISIT], validate=False)
    before = rows(warehouse.table(FACT_VISIT.target))
    new_run(warehouse, T2, "r2").run([DIM_PERSON, FACT_VISIT], validate=False)
    assert rows(warehouse.table(FACT_VISIT.target)) == before


def test_first_failure_stops_and_is_logged_and_a_good_rerun_clears_it(warehouse):
    load_raw(warehouse)
    broken = BuildSpec(DIM_PERSON.target, ("person",), tuple(
        ColumnMapping("full_name", S.EXPRESSION, expression="raise_error('broken')") if m.target_column == "full_name" else m
        for m in DIM_PERSON.columns))
    with pytest.raises(StepFailed, match="dim_person.read failed"):
        new_run(warehouse).run([broken, FACT_VISIT])
    log = warehouse.table(LOG_TABLE)
    assert [(r["stage"], r["status"], r["rows_affected"]) for r in log.collect()] == [("read", "failure", None)]
    assert log.first()["error_message"] and warehouse.table(DIM_PERSON.target).count() == 0
    assert runlog.latest_run_status(log).first()["status"] == "FAIL"
    new_run(warehouse, T2, "r2").run([DIM_PERSON], validate=False)
    assert runlog.latest_run_status(warehouse.table(LOG_TABLE)).first()["status"] == "PASS"


def test_repeated_dimension_key_stops_the_fact(warehouse):
    load_raw(warehouse, people=PEOPLE + [PEOPLE[0]])
    with pytest.raises(StepFailed, match="fact_visit.process failed: dim_person is not unique"):
        new_run(warehouse).run([DIM_PERSON, FACT_VISIT])
    assert not warehouse.exists(REPORT_TABLE)


# --- versioned and incremental ------------------------------------------------------

DIM_VERSIONS = BuildSpec(
    TableSpec("analytics", "dim_person_v", (
        column("person_dk", "VARCHAR(32)", pk=True), column("person_bk", "VARCHAR(10)", nullable=False),
        column("full_name", "VARCHAR(200)"), column("email", "VARCHAR(50)"), column("hashdiff", "VARCHAR(32)"),
        column("valid_from", "TIMESTAMP", nullable=False), column("valid_to", "TIMESTAMP"),
        column("is_current", "BOOLEAN", nullable=False))),
    ("person",),
    (ColumnMapping("person_dk", S.UDF, udf=Call("udf_generate_dk", (Call("udf_calculate_patient_bk", ("id",)), S.RUN_TIMESTAMP))),
     ColumnMapping("person_bk", S.UDF, "id", udf="udf_calculate_patient_bk"),
     ColumnMapping("full_name", S.UDF, ("first", "last"), udf="udf_full_name"),
     ColumnMapping("email", S.UDF, "email", udf="udf_clean_email"),
     ColumnMapping("hashdiff", S.UDF, ("first", "last", "email"), udf="udf_hashdiff"),
     ColumnMapping("valid_from", S.CONSTANT, value=S.RUN_TIMESTAMP),
     ColumnMapping("valid_to", S.CONSTANT, value=None), ColumnMapping("is_current", S.CONSTANT, value=True)),
    "scd2", load_options={"keys": ["person_bk"], "tracked": ["full_name", "email"]})


def versions(warehouse):
    return rows(warehouse.table(DIM_VERSIONS.target).select("person_bk", "full_name", "valid_from", "valid_to", "is_current"))


def test_versioned_dimension_over_three_runs(warehouse):
    load_raw(warehouse)
    new_run(warehouse, T1).run([DIM_VERSIONS], validate=False)
    load_raw(warehouse, people=[("P1", "Ann", "Lee", None, "a@x.in", "Y"), PEOPLE[1], ("P4", "New", "One", None, None, "Y")])
    report = new_run(warehouse, T2, "r2").run([DIM_VERSIONS])
    expected = sorted([
        ("P1", "Anne Lee", T1, T2, False), ("P1", "Ann Lee", T2, None, True), ("P2", "José", T1, None, True),
        ("P3", "Anne Lee", T1, None, True), ("P4", "New One", T2, None, True)], key=repr)
    assert versions(warehouse) == expected
    status = {r["check_id"]: r["status"] for r in report.collect()}
    assert status["D-duplicates-dim_person_v"] == "PASS" and status["D-late-dim_person_v"] == "PASS"
    new_run(warehouse, T2 + datetime.timedelta(days=1), "r3").run([DIM_VERSIONS], validate=False)
    assert versions(warehouse) == expected
    load_raw(warehouse)
    report = new_run(warehouse, T1, "r4").run([DIM_VERSIONS])
    late = {r["check_id"]: (r["status"], r["n"]) for r in report.collect()}["D-late-dim_person_v"]
    assert late == ("WARN", 1) and versions(warehouse) == expected


def visits_spec(partition_by=(), **options):
    return BuildSpec(
        TableSpec("analytics", "fact_day", (
            column("visit_id", "INT", pk=True), column("fee", "NUMERIC(10,2)"), column("day", "DATE")), partition_by),
        ("visit",),
        (ColumnMapping("visit_id", S.DIRECT, "visit_id"), ColumnMapping("fee", S.DIRECT, "fee"), ColumnMapping("day", S.DIRECT, "day")),
        "incremental", load_options=options)


def days(warehouse, spec):
    return rows(warehouse.table(spec.target).select("visit_id", F.col("fee").cast("int"), F.dayofmonth("day")))


def test_incremental_append(warehouse):
    spec = visits_spec(timestamp="day", source_timestamp="day")
    load_raw(warehouse)
    new_run(warehouse).run([spec], validate=False)
    load_raw(warehouse, visits=VISITS + [(4, "P1", datetime.date(2026, 1, 3), 7.0)])
    new_run(warehouse, T2, "r2").run([spec], validate=False)
    assert days(warehouse, spec) == [(1, 10, 1), (2, 20, 2), (3, 5, 2), (4, 7, 3)]
    written = warehouse.table(LOG_TABLE).where("run_id = 'r2' AND stage = 'write'").first()
    assert written["rows_affected"] == 1


@pytest.mark.parametrize("partition_by", [(), ("day",)])
def test_incremental_upsert(warehouse, partition_by):
    spec = visits_spec(partition_by, timestamp="day", keys=["visit_id"])
    load_raw(warehouse)
    new_run(warehouse).run([spec], validate=False)
    files = set(warehouse.table(spec.target).where("day = '2026-01-01'").inputFiles())
    # visit 2 moves to another day and empties nothing, visit 3 moves and empties its day
    load_raw(warehouse, visits=[(2, "P2", datetime.date(2026, 1, 5), 99.0), (3, "P9", datetime.date(2026, 1, 5), 6.0)])
    new_run(warehouse, T2, "r2").run([spec], validate=False)
    assert days(warehouse, spec) == [(1, 10, 1), (2, 99, 5), (3, 6, 5)]
    if partition_by:
        assert set(warehouse.table(spec.target).where("day = '2026-01-01'").inputFiles()) == files
        assert {p["day"] for p in warehouse.versioned(spec.target).partitions()} == {"2026-01-01", "2026-01-05"}


def test_upsert_keeps_the_generated_keys_of_known_rows(warehouse):
    spec = BuildSpec(
        TableSpec("analytics", "fact_seq", (
            column("visit_key", "BIGINT", pk=True), column("visit_id", "INT"), column("day", "DATE"),
            column("fee", "INT"))),
        ("visit",),
        (ColumnMapping("visit_key", S.SEQUENCE, order_by=("visit_id",)), ColumnMapping("visit_id", S.DIRECT, "visit_id"),
         ColumnMapping("day", S.DIRECT, "day"), ColumnMapping("fee", S.DIRECT, "fee")),
        "incremental", load_options={"keys": ["visit_id"], "timestamp": "day"})
    load_raw(warehouse)
    new_run(warehouse).run([spec], validate=False)
    load_raw(warehouse, visits=[(2, "P2", datetime.date(2026, 1, 5), 99.0), (4, "P9", datetime.date(2026, 1, 5), 6.0)])
    new_run(warehouse, T2, "r2").run([spec], validate=False)
    got = rows(warehouse.table(spec.target).select("visit_id", "visit_key", "fee"))
    assert [r[0] for r in got] == [1, 2, 3, 4] and got[1] == (2, 2, 99)
    assert got[3][1] > 3 and len({r[1] for r in got}) == 4


def test_descriptions_become_comments(warehouse):
    spec = TableSpec("analytics", "told", (column("a", "INT", description="it's a"),), description="a table")
    warehouse.create_table(spec)
    assert warehouse.spark.catalog.listColumns(warehouse.name(spec))[0].description == "it's a"


# --- warehouse ----------------------------------------------------------------------

WORDS = TableSpec("analytics", "words", (column("id", "INT"), column("word", "VARCHAR(5)")))


def test_too_long_values_fail_and_leave_the_table_alone(warehouse):
    make = lambda *r: warehouse.spark.createDataFrame(list(r), "id int, word string")
    warehouse.replace(WORDS, make((1, "abc")))
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        warehouse.replace(WORDS, make((1, "abc"), (2, "abcdef")))
    assert rows(warehouse.table(WORDS)) == [(1, "abc")]


def test_replace_may_read_its_own_table(warehouse):
    warehouse.replace(WORDS, warehouse.spark.createDataFrame([(1, "abc")], "id int, word string"))
    own = warehouse.table(WORDS)
    assert warehouse.replace(WORDS, own.unionByName(own.withColumn("id", F.col("id") + 1))) == 2
    assert rows(warehouse.table(WORDS)) == [(1, "abc"), (2, "abc")]


def test_same_name_in_two_namespaces(warehouse):
    other = TableSpec("raw", "words", (column("id", "INT"),))
    warehouse.replace(WORDS, warehouse.spark.createDataFrame([(1, "abc")], "id int, word string"))
    warehouse.replace(other, warehouse.spark.createDataFrame([(7,)], "id int"))
    assert warehouse.table(WORDS).columns == ["id", "word"] and rows(warehouse.table(other)) == [(7,)]


def test_truncate_and_reset(warehouse):
    warehouse.replace(WORDS, warehouse.spark.createDataFrame([(1, "abc")], "id int, word string"))
    warehouse.truncate(WORDS)
    assert warehouse.table(WORDS).count() == 0
    with pytest.raises(ValueError, match="default"):
        warehouse.reset(["analytics", "default"])
    assert warehouse.exists(WORDS)
    assert warehouse.reset(["analytics"]) == ["analytics"]
    assert not warehouse.exists(WORDS)


def test_typed_readers(spark, tmp_path):
    (tmp_path / "v.csv").write_text("visit_id,person_id,day,fee\n1,P1,2026-01-01,10.50\n")
    assert rows(readers.read_csv(spark, str(tmp_path / "v.csv"), VISIT))[0][2:] == (
        datetime.date(2026, 1, 1), __import__("decimal").Decimal("10.50"))
    (tmp_path / "bad.csv").write_text("visit_id,person_id,day,fee\nx,P1,2026-01-01,10.50\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        readers.read_csv(spark, str(tmp_path / "bad.csv"), VISIT).collect()
    (tmp_path / "v.json").write_text('{"visit_id": 1, "day": "2026-01-01", "fee": 2.5, "more": 1}\n')
    assert rows(readers.read_json(spark, str(tmp_path / "v.json"), VISIT))[0][:3] == (1, None, datetime.date(2026, 1, 1))
    text = spark.createDataFrame([("1", "P", "soon", "x")], "visit_id string, person_id string, day string, fee string")
    assert rows(readers.typed(text, VISIT, try_cast=True)) == [(1, "P", None, None)]


# --- run log ------------------------------------------------------------------------


def test_run_status_and_event_record(spark):
    at = lambda d: datetime.datetime(2026, d, 1)
    step = lambda run, seq, status, d, error=None: runlog.StepRecord(run, seq, "t", "read", at(d), at(d), status, None, "h", error)
    log = runlog.log_rows(spark, [step("a", 1, "success", 2), step("a", 3, "failure", 2, "second"),
                                  step("a", 2, "failure", 2, "first"), step("b", 1, "success", 8)])
    assert rows(runlog.run_status(log)) == [("a", "FAIL", "t.read failed: first", 3, 2),
                                           ("b", "PASS", "1 step(s) completed successfully", 1, 0)]
    assert runlog.latest_run_status(log).first().asDict() == {
        "run_id": "b", "status": "PASS", "detail": "1 step(s) completed successfully"}
    nothing = runlog.latest_run_status(log.where("seq > 9")).first()
    assert (nothing["status"], nothing["detail"]) == ("WARN", "not yet run")
    report = spark.createDataFrame([("b", "PASS"), ("b", "WARN")], "run_id string, status string")
    record = {r["run_id"]: r for r in runlog.event_record(log, report).collect()}
    assert (record["a"]["year"], record["a"]["quarter"], record["a"]["failed"], record["a"]["checks"]) == (2026, "Q1", 2, None)
    assert (record["b"]["quarter"], record["b"]["validation"], record["b"]["warn"]) == ("Q3", "WARN", 1)


def event_records_by_quarter(spark, folder, orders, events):
    """What the query gives and what its SQL gives, columns by name."""
    import duckdb
    from starload.plans import star_queries
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(events, "event_id long, user_id long, event_type string").write.parquet(f"{folder}/events.parquet")
    found = star_queries.event_record_by_quarter(spark, str(folder))
    with duckdb.connect() as con:
        for t in ("orders", "events"):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
        sql = con.sql(star_queries.ORACLES["event_record_by_quarter"])
        assert sorted(found.columns) == sorted(sql.columns)
        return rows(found.select(*sql.columns)), sorted(sql.fetchall(), key=repr)


def test_event_record_by_quarter(spark, tmp_path):
    at = lambda m: datetime.datetime(2026, m, 1)
    found, sql = event_records_by_quarter(
        spark, tmp_path, [(1, 7, "F", at(5)), (2, 7, "O", at(2)), (3, 8, "P", at(11))],
        [(1, 7, "view"), (2, 7, "click"), (3, 9, "error")])
    assert found == [(2026, "Q1", "7", at(2), 2, 1, 1, "WARN", 2, 1, 1, 0),
                     (2026, "Q4", "8", at(11), 1, 1, 0, None, None, None, None, None)]
    assert found == sql


def test_event_record_by_quarter_of_rows_without_a_status(spark, tmp_path):
    at = lambda m: datetime.datetime(2026, m, 1)
    found, sql = event_records_by_quarter(
        spark, tmp_path, [(1, 7, "O", at(2)), (2, 7, None, at(3)), (3, 8, None, None), (4, None, "F", at(8))],
        [(1, 7, "click"), (2, 7, None), (3, 8, None), (4, None, "error")])
    assert found == [(2026, "Q1", "7", at(2), 2, 1, 0, "PASS", 2, 1, 0, 0),
                     (2026, "Q3", None, at(8), 1, 0, 1, None, None, None, None, None),
                     (None, None, "8", None, 1, 0, 0, "PASS", 1, 0, 0, 0)]
    assert found == sql


def test_vacuum_keeps_only_what_the_table_uses(warehouse):
    make = lambda *r: warehouse.spark.createDataFrame(list(r), "id int, word string")
    for i in range(3):
        warehouse.replace(WORDS, make((i, "abc")))
    assert warehouse.vacuum(WORDS) >= 2
    assert rows(warehouse.table(WORDS)) == [(2, "abc")] and warehouse.vacuum(WORDS) == 0


def test_a_run_leaves_nothing_in_the_shared_folder(warehouse):
    from starload.scratch import list_folders, materialise, scratch_root, workspace
    spark = warehouse.spark
    folder = f"{scratch_root(spark)}/starload"
    before = set(list_folders(spark, folder))
    with workspace(spark):
        assert materialise(spark.range(3), "x").count() == 3
        assert len(set(list_folders(spark, folder)) - before) == 1
    load_raw(warehouse)
    new_run(warehouse).run([DIM_PERSON, FACT_VISIT])
    assert set(list_folders(spark, folder)) == before


def test_bucketed_table_is_joined_and_checked_without_a_shuffle(warehouse):
    from conftest import plan_of
    from starload.operators import load, quality
    spark = warehouse.spark
    spec = TableSpec("analytics", "bucketed", (
        column("k", "BIGINT", pk=True), column("v", "BIGINT")), bucket_by=("k",), buckets=8)
    data = spark.range(1000).select(F.col("id").alias("k"), F.col("id").alias("v"))
    for _ in range(2):
        warehouse.replace(spec, data)
    table = warehouse.table(spec)
    assert table.count() == 1000 and len(table.inputFiles()) == 8
    assert plan_of(quality.duplicate_groups(table, ["k"])).count("Exchange") == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = load.upsert(table, data.withColumn("v", F.col("v") + 1), ["k"], "v")
        kept = plan_of(merged).partition("LeftAnti")[2].partition("FileScan")[0]
        assert "Exchange" not in kept
        assert merged.count() == 1000 and merged.agg(F.min("v")).first()[0] == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitioned_tables(warehouse):
    spec = TableSpec("analytics", "parts", (
        column("id", "INT", pk=True), column("word", "VARCHAR(5)"), column("y", "INT"), column("s", "TEXT")), ("y", "s"))
    make = lambda *r: warehouse.spark.createDataFrame(list(r), "id int, word string, y int, s string")
    for i in range(2):
        assert warehouse.replace(spec, make((1, "a", 2020, "x"), (2, "b", None, "it's"), (3, "c", 2021, None), (4, "d", 2022, "/z"))) == 4
    assert warehouse.table(spec).count() == 4
    target = warehouse.table(spec)
    new = make((2, "B", None, "it's"), (3, "C", 2020, "x"))
    touched = target.where("id in (2, 3)").select("y", "s").unionByName(new.select("y", "s"))
    affected = target.where("id <> 4")
    warehouse.replace_partitions(spec, affected.where("id = 1").unionByName(new), touched)
    assert rows(warehouse.table(spec)) == sorted([(1, "a", 2020, "x"), (2, "B", None, "it's"), (3, "C", 2020, "x"), (4, "d", 2022, "/z")], key=repr)
    warehouse.truncate(spec)
    assert warehouse.table(spec).count() == 0
    with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
        warehouse.append(spec, make((9, "abcdef", 1, "x")))
    assert warehouse.table(spec).count() == 0


def test_text_files_as_a_source(warehouse, tmp_path):
    (tmp_path / "visits").mkdir()
    (tmp_path / "visits" / "v.csv").write_text("visit_id;person_id;day;fee\n1;P1;2026-01-01;10.50\n2;P2;2026-01-02;1\n")
    warehouse.attach("raw.visit", str(tmp_path / "visits"), spec=VISIT, format="csv", header="true", sep=";")
    spec = visits_spec(timestamp="day", source_timestamp="day")
    new_run(warehouse).run([spec], validate=False)
    assert days(warehouse, spec) == [(1, 10, 1), (2, 1, 2)]
