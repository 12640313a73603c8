"""Tables kept by their loads: what a reader sees, what stays as it is, what a lost or repeated load leaves."""

import datetime

import pytest
from pyspark.sql import functions as F

from conftest import plan_of, rows
from starload import spec as S
from starload.functions.registry import FunctionRegistry
from starload.operators import load
from starload.plans.load import LOG_TABLE, RANGES_TABLE, REPORT_TABLE, LoadRun, StepFailed
from starload.sources import versioned
from starload.sources.versioned import State
from starload.sources.warehouse import CatalogMerger
from starload.spec import BuildSpec, ColumnMapping, TableSpec, column

PARTS = TableSpec("analytics", "parts", (column("id", "INT", pk=True), column("word", "VARCHAR(5)"), column("y", "INT")), ("y",))


def made(warehouse, *data):
    return warehouse.spark.createDataFrame(list(data), "id int, word string, y int")


def years(warehouse):
    return {p["y"]: p for p in warehouse.versioned(PARTS).partitions()}


def test_one_change_shows_all_partitions_of_a_load(warehouse, monkeypatch):
    warehouse.replace(PARTS, made(warehouse, *[(i, "a", 2000 + i) for i in range(30)]))
    before = warehouse.table(PARTS)
    said, sql = [], warehouse.spark.sql
    monkeypatch.setattr(warehouse.spark, "sql", lambda text, *a, **k: said.append(text) or sql(text, *a, **k))
    seen, insert = [], warehouse.insert

    def slow(name, df, spec):
        written = insert(name, df, spec)
        seen.append(rows(warehouse.table(PARTS)))  # all files are there, nothing of them is shown
        return written
    monkeypatch.setattr(warehouse, "insert", slow)
    new = made(warehouse, *[(i, "b", 2000 + i) for i in range(20)])
    warehouse.merge(PARTS, new, ["id"])
    assert [sorted(s) for s in seen] == [[(i, "a", 2000 + i) for i in range(30)]]
    assert sorted(rows(warehouse.table(PARTS))) == [(i, "b" if i < 20 else "a", 2000 + i) for i in range(30)]
    changes = [text.split()[0:2] for text in said if not text.startswith(("SHOW", "DESCRIBE"))]
    assert len(changes) == 2 and changes[-1] == ["CREATE", "OR"]  # one to begin, one to show: none per partition
    assert before.count() == 30


def test_only_folders_that_count_are_listed(warehouse):
    warehouse.replace(PARTS, made(warehouse, (1, "a", 2020), (2, "b", 2021), (3, "c", None)))
    kept = set(warehouse.table(PARTS).where("y = 2021").inputFiles())
    warehouse.replace_partitions(PARTS, made(warehouse, (4, "d", 2020)), made(warehouse, (0, "", 2020)).select("y"))
    assert rows(warehouse.table(PARTS)) == sorted([(4, "d", 2020), (2, "b", 2021), (3, "c", None)], key=repr)
    assert set(warehouse.table(PARTS).where("y = 2021").inputFiles()) == kept
    assert len(warehouse.table(PARTS).inputFiles()) == 3
    warehouse.replace_partitions(PARTS, made(warehouse), warehouse.table(PARTS).where("y IS NULL").select("y"))
    assert rows(warehouse.table(PARTS)) == [(2, "b", 2021), (4, "d", 2020)] and set(years(warehouse)) == {"2020", "2021"}


def test_a_load_that_is_lost_is_never_seen(warehouse, monkeypatch):
    warehouse.replace(PARTS, made(warehouse, (1, "a", 2020)))

    def lost(self, state):
        raise RuntimeError("driver lost")
    with monkeypatch.context() as m:
        m.setattr(versioned.VersionedTable, "_show", lost)
        with pytest.raises(RuntimeError):
            warehouse.append(PARTS, made(warehouse, (9, "x", 2020)))
    assert rows(warehouse.table(PARTS)) == [(1, "a", 2020)]
    warehouse.append(PARTS, made(warehouse, (2, "b", 2020)))
    assert rows(warehouse.table(PARTS)) == [(1, "a", 2020), (2, "b", 2020)]
    assert warehouse.vacuum(PARTS) == 1 and warehouse.vacuum(PARTS) == 0
    warehouse.append(PARTS, made(warehouse, (3, "c", 2021)))
    assert rows(warehouse.table(PARTS)) == [(1, "a", 2020), (2, "b", 2020), (3, "c", 2021)]


def test_a_repeated_run_replaces_its_own_rows(warehouse):
    for run, row in (("r1", (1, "a", 1)), ("r2", (2, "b", 1)), ("r2", (3, "c", 2)), ("r1", (4, "d", 1))):
        warehouse.append(PARTS, made(warehouse, row), run)
    assert rows(warehouse.table(PARTS)) == [(3, "c", 2), (4, "d", 1)]
    assert rows(warehouse.versioned(PARTS).rows(without_run="r1")) == [(3, "c", 2)]
    assert warehouse.vacuum(PARTS) == 2 and len(rows(warehouse.table(PARTS))) == 2


def test_a_long_state_fits_into_properties(warehouse):
    spec = TableSpec("analytics", "many", (column("id", "INT"), column("s", "TEXT")), ("s",))
    data = warehouse.spark.range(300).selectExpr("CAST(id AS INT) AS id", "concat('it''s \"', id % 150, '\\\\') AS s")
    warehouse.replace(spec, data)
    warehouse.replace_partitions(spec, data.where("id < 150"), data.select("s"))
    assert len(warehouse.versioned(spec).state().since) == 150
    assert rows(warehouse.table(spec)) == rows(data.where("id < 150"))
    assert warehouse.vacuum(spec) == 150 and warehouse.table(spec).count() == 150


def test_states():
    state = State().next(everything=False, replaced=[{"y": "1"}], run="a")
    assert (state.committed, state.since, state.runs) == (1, [({"y": "1"}, 1)], {"a": 1})
    state.attempt = 2
    state = state.next(everything=False, replaced=[{"y": "1"}, {"y": None}], run="a")
    assert (state.committed, state.hidden, state.since) == (3, [1, 2], [({"y": "1"}, 3), ({"y": None}, 3)])
    assert state.counts({"y": "1", "_load": "3"}) and not state.counts({"y": "2", "_load": "2"})
    assert not state.counts({"y": None, "_load": "2"}) and not state.counts({"y": "1", "_load": "4"})
    assert state.next(everything=True, replaced=[], run=None).base == 4


# --- merge ------------------------------------------------------------------------------


class StubCatalog:
    """A catalog that can merge some tables, and remembers what it was asked to."""

    def __init__(self, *tables):
        self.tables, self.merged = tables, []

    def can_merge(self, table):
        return any(t in table for t in self.tables)

    def merge(self, table, batch, on):
        self.merged.append((table, rows(batch), list(on)))
        return batch.count()


VERSIONS = BuildSpec(
    TableSpec("analytics", "dim_v", (
        column("k", "INT", nullable=False), column("word", "TEXT"), column("hashdiff", "VARCHAR(32)"), column("valid_from", "TIMESTAMP"),
        column("valid_to", "TIMESTAMP"), column("is_current", "BOOLEAN"))),
    ("words",),
    (ColumnMapping("k", S.DIRECT, "k"), ColumnMapping("word", S.DIRECT, "word"),
     ColumnMapping("hashdiff", S.UDF, ("word",), udf="udf_hashdiff"), ColumnMapping("valid_from", S.CONSTANT, value=S.RUN_TIMESTAMP),
     ColumnMapping("valid_to", S.CONSTANT), ColumnMapping("is_current", S.CONSTANT, value=True)),
    "scd2", load_options={"keys": ["k"], "tracked": ["word"]})
LATEST = BuildSpec(
    TableSpec("analytics", "latest", (column("k", "INT", pk=True), column("word", "TEXT"), column("at", "INT"))),
    ("words",), tuple(ColumnMapping(c, S.DIRECT, c) for c in ("k", "word", "at")),
    "incremental", load_options={"keys": ["k"], "timestamp": "at"})
WORDS = TableSpec("raw", "words", (column("k", "INT", pk=True), column("word", "TEXT"), column("at", "INT")))


def run_words(warehouse, spec, month, *data, name=None, validate=False):
    warehouse.replace(WORDS, warehouse.spark.createDataFrame(list(data), "k int, word string, at int"))
    run = LoadRun(warehouse, {"words": WORDS}, FunctionRegistry(), datetime.datetime(2025, month, 1), name or f"run-{month}")
    return run.run([spec], validate=validate)


def test_upserts_and_versions_go_through_a_catalog_that_merges(warehouse):
    warehouse.merger = StubCatalog("latest", "dim_v")
    run_words(warehouse, LATEST, 1, (1, "a", 5), (1, "b", 7))
    run_words(warehouse, VERSIONS, 1, (1, "a", 5))
    (upsert, versions) = warehouse.merger.merged
    assert upsert[1:] == ([(1, "b", 7)], ["k"]) and versions[2] == ["k", "valid_from"]
    assert [r[:2] + r[4:] for r in versions[1]] == [(1, "a", None, True)]
    assert warehouse.table(LATEST.target).count() == 0  # nothing was written beside the merge


def test_a_merged_version_closes_its_row_by_the_same_keys(warehouse):
    run_words(warehouse, VERSIONS, 1, (1, "a", 0), (2, "x", 0))
    warehouse.merger = StubCatalog("dim_v")
    run_words(warehouse, VERSIONS, 2, (1, "b", 0), (2, "x", 0))
    one, two = datetime.datetime(2025, 1, 1), datetime.datetime(2025, 2, 1)
    assert [(r[0], r[1], *r[3:]) for r in warehouse.merger.merged[0][1]] == [(1, "a", one, two, False), (1, "b", two, None, True)]


def test_parquet_tables_are_not_merged_by_the_catalog(warehouse):
    run_words(warehouse, LATEST, 1, (1, "a", 5))
    assert not CatalogMerger(warehouse.spark).can_merge(warehouse.name(LATEST.target))
    assert CatalogMerger(warehouse.spark, ["parquet"]).can_merge(warehouse.name(LATEST.target))


@pytest.mark.parametrize("partition_by", [(), ("y",)])
def test_merge_by_rewriting(warehouse, partition_by):
    spec = TableSpec("analytics", "merged", PARTS.columns, partition_by)
    warehouse.replace(spec, made(warehouse, (1, "a", 1), (2, "b", 1), (3, "c", 2), (None, "n", 2)))
    warehouse.merge(spec, made(warehouse, (2, "B", 3), (4, "D", 1)), ["id"])
    assert rows(warehouse.table(spec)) == sorted([(1, "a", 1), (2, "B", 3), (3, "c", 2), (4, "D", 1), (None, "n", 2)], key=repr)


# --- ended versions ---------------------------------------------------------------------


def test_ended_versions_are_only_ever_added_to(warehouse):
    for month, word in ((1, "a"), (2, "b"), (3, "c")):
        run_words(warehouse, VERSIONS, month, (1, word, 0), (2, "same", 0))
    kept = warehouse.versioned(VERSIONS.target)

    def files(period):
        return set(kept.spark.table(kept.files).where(F.col("_closed") == period).inputFiles())
    ended = {p: files(p) for p in ("2025-02", "2025-03")}
    assert all(ended.values())
    run_words(warehouse, VERSIONS, 4, (1, "d", 0), (2, "other", 0))
    assert {p: files(p) for p in ended} == ended and files("2025-04")
    got = rows(warehouse.table(VERSIONS.target).select("k", "word", F.month("valid_from"), F.month("valid_to"), "is_current"))
    assert got == [(1, "a", 1, 2, False), (1, "b", 2, 3, False), (1, "c", 3, 4, False), (1, "d", 4, None, True),
                   (2, "other", 4, None, True), (2, "same", 1, 4, False)]
    open_files = warehouse.open_versions(VERSIONS.target).inputFiles()
    assert open_files and all("_closed=open" in f for f in open_files)


def test_a_batch_is_held_against_the_open_versions_once(warehouse, monkeypatch):
    run_words(warehouse, VERSIONS, 1, (1, "a", 0))
    calls, real = [], load.against_current
    monkeypatch.setattr(load, "against_current", lambda *a: calls.append(a) or real(*a))
    run_words(warehouse, VERSIONS, 2, (1, "b", 0))
    assert len(calls) == 1 and all("_closed=open" in f for f in calls[0][0].inputFiles())


def test_missing_keys_can_be_closed(warehouse):
    spec = S.replace(VERSIONS, load_options={**VERSIONS.load_options, "close_missing": True})
    run_words(warehouse, spec, 1, (1, "a", 0), (2, "x", 0))
    run_words(warehouse, spec, 2, (1, "b", 0))
    got = rows(warehouse.table(spec.target).select("k", "word", F.month("valid_to"), "is_current"))
    assert got == [(1, "a", 2, False), (1, "b", None, True), (2, "x", 2, False)]


# --- appends ------------------------------------------------------------------------------

FACTS = TableSpec("raw", "facts", (column("id", "INT", pk=True), column("at", "DATE")))
APPEND = BuildSpec(
    TableSpec("analytics", "facts_loaded", (column("id", "INT", pk=True), column("at", "DATE"))), ("facts",),
    (ColumnMapping("id", S.DIRECT, "id"), ColumnMapping("at", S.DIRECT, "at")),
    "incremental", load_options={"timestamp": "at", "source_timestamp": "at"})


def append_run(warehouse, name, data, validate=False):
    warehouse.replace(FACTS, warehouse.spark.createDataFrame(data, "id int, at date"))
    run = LoadRun(warehouse, {"facts": FACTS}, FunctionRegistry(), datetime.datetime(2025, 12, 1), name)
    return run, run.run([APPEND], validate=validate)


def day(month, number=1):
    return datetime.date(2025, month, number)


HISTORY = [(100 * m + i, day(m, 1 + i)) for m in range(1, 7) for i in range(20)]


def test_an_append_joins_changed_ranges_only(warehouse, monkeypatch):
    append_run(warehouse, "a", HISTORY)
    joined, real = [], load._not_in
    monkeypatch.setattr(load, "_not_in", lambda s, t, k: joined.append((s, t)) or real(s, t, k))
    data = HISTORY + [(7000, day(7)), (7001, day(2, 28))]  # one new row, one that comes too late
    run, _ = append_run(warehouse, "b", data)
    older, known = joined[0]
    assert {r.at.month for r in older.collect()} == {2, 6} and {r.at.month for r in known.collect()} == {2, 6}
    assert "Or(And(GreaterThanOrEqual(at" in older._jdf.queryExecution().executedPlan().toString()
    assert rows(warehouse.table(APPEND.target)) == sorted(HISTORY + [(7000, day(7))])
    assert rows(warehouse.table("staging.late_facts_loaded").select("id")) == [(7001,)]
    joined.clear()
    append_run(warehouse, "c", [d for d in data if d[0] != 7001])
    assert {r.at.month for r in joined[0][0].collect()} == set()  # before the newest row's month nothing differs


def test_fingerprints_that_are_not_those_of_the_table_are_made_again(warehouse):
    append_run(warehouse, "a", HISTORY)
    warehouse.append(APPEND.target, warehouse.spark.createDataFrame([(1, day(3, 30))], "id int, at date"))
    append_run(warehouse, "b", HISTORY + [(1, day(3, 30)), (8000, day(8))])
    assert rows(warehouse.table(APPEND.target)) == sorted(HISTORY + [(1, day(3, 30)), (8000, day(8))])
    assert warehouse.table("staging.late_facts_loaded").count() == 0
    ranges = warehouse.table(RANGES_TABLE).agg(F.sum("rows")).first()[0]
    assert ranges == len(HISTORY) + 2
    warehouse.truncate(APPEND.target)
    append_run(warehouse, "c", HISTORY)
    assert rows(warehouse.table(APPEND.target)) == sorted(HISTORY)


def test_a_run_lost_behind_its_write_can_be_repeated(warehouse, monkeypatch):
    append_run(warehouse, "a", HISTORY)
    more = HISTORY + [(9000 + i, day(9, 1 + i)) for i in range(5)]
    with monkeypatch.context() as m:
        def lost(*a):
            raise RuntimeError("lost")
        m.setattr(LoadRun, "_keep_ranges", lost)
        with pytest.raises(StepFailed):
            append_run(warehouse, "b", more)
    _, report = append_run(warehouse, "b", more, validate=True)
    assert rows(warehouse.table(APPEND.target)) == sorted(more)
    assert {r["status"] for r in report.collect()} == {"PASS"}
    log = warehouse.table(LOG_TABLE).where("run_id = 'b'")
    assert [(r["seq"], r["status"]) for r in log.orderBy("seq").collect()] == [(i, "success") for i in (1, 2, 3, 4)]
    assert warehouse.table(REPORT_TABLE).where("run_id = 'b'").count() == report.count()


def test_runs_write_their_reports_apart(warehouse):
    row = warehouse.spark.range(2).selectExpr("CAST(id AS INT) AS a")
    for run in ("x/1", "y"):
        warehouse.report_of_run("analytics.told", row, {"day": day(1), "run_id": run})
    warehouse.report_of_run("analytics.told", row.limit(1), {"day": day(1), "run_id": "y"}, renew=False)
    got = warehouse.table("analytics.told")
    assert {(r.run_id, r.n) for r in got.groupBy("run_id").agg(F.count("*").alias("n")).collect()} == {("x/1", 2), ("y", 3)}
    assert len({f.rpartition("/")[0] for f in got.inputFiles()}) == 2


# --- reconciliation of a batch ------------------------------------------------------------


def test_a_batch_is_checked_without_the_whole_source(warehouse, spark):
    from starload.operators import quality
    from starload.plans import reconcile
    from starload.plans.build import Mapper
    append_run(warehouse, "a", HISTORY)
    append_run(warehouse, "b", HISTORY + [(7000, day(7))])
    staged = warehouse.table("staging.stg_facts_loaded")
    sources = {"facts": warehouse.table(FACTS)}
    reduced = reconcile.sources_of_batch(APPEND, FACTS, sources, staged, Mapper(APPEND))["facts"]
    assert rows(reduced) == [(7000, day(7))]
    plan = plan_of(reduced)
    assert "GreaterThanOrEqual(at,2025-07-01)" in plan and "LeftSemi" in plan
    counts = quality.recompute(staged, reduced, {"id": F.col("id")}, {"at": F.col("at")}, hot_rows=None)
    whole = plan_of(counts)
    assert whole.index("LeftSemi") > whole.index("HashAggregate")  # the semi-join lies below every aggregate
    assert counts.first().asDict() == {"checked": 1, "skipped": 0, "at": 0}
