"""Queries of loads that go wrong quietly: ties, late rows, several changes at once, keys that repeat.

The inputs hold the bad cases; every query reads its tables whole.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from starload.functions.registry import FunctionRegistry
from starload.operators import load, quality
from starload.plans import reconcile, star
from starload.plans.build import Mapper, build
from starload.plans.ingest import ingest, rejected_table
from starload.plans.load import LOG_TABLE, REPORT_TABLE, LoadRun, StepFailed
from starload.plans.star_queries import (
    BUILD_CUSTOMER_VERSIONS, CUSTOMER_CHANGES, HISTORY_SQL, customer_snapshots, history, one, project, query, read, two_runs,
)
from starload.scratch import fresh_path
from starload.spec import (
    DIRECT, EXPRESSION, LOOKUP, SEQUENCE, UDF, BuildSpec, ColumnMapping, Lookup, TableSpec, column,
)

ORDER_FEED = TableSpec("raw", "order_feed", (
    column("o_orderkey", "BIGINT", pk=True), column("o_custkey", "BIGINT"), column("ordered", "TIMESTAMP")))
BUILD_ORDER_FEED = BuildSpec(
    TableSpec("analytics", "order_feed_loaded", (
        column("order_id", "BIGINT", pk=True), column("customer_id", "BIGINT"), column("ordered", "TIMESTAMP"))),
    ("order_feed",),
    (ColumnMapping("order_id", DIRECT, "o_orderkey"), ColumnMapping("customer_id", DIRECT, "o_custkey"),
     ColumnMapping("ordered", DIRECT, "ordered")),
    "incremental", load_options={"timestamp": "ordered", "source_timestamp": "ordered"})

FEED_SQL = """
WITH feed AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 > 0 THEN o_orderdate END AS ordered FROM orders),
     first AS (SELECT * FROM feed WHERE o_orderkey % 3 > 0 AND (ordered IS NULL OR ordered < TIMESTAMP '1999-01-01')),
     newest AS (SELECT max(ordered) AS moment FROM first)
"""


def _feed_runs(spark, sf_dir, names=("run-0", "run-1", "run-2")):
    """Three runs: two thirds of the orders up to 1998; then all, with ties, missing and older moments; then all again."""
    ordered = F.when(F.col("o_orderkey") % 11 > 0, F.col("o_orderdate"))
    feed = one(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", ordered.alias("ordered"))
    early = F.col("ordered").isNull() | (F.col("ordered") < F.lit("1999-01-01").cast("timestamp_ntz"))
    warehouse = project(spark, sf_dir)
    for i, (name, rows) in enumerate(zip(names, (feed.where("o_orderkey % 3 > 0").where(early), feed, feed))):
        warehouse.replace(ORDER_FEED, rows)
        run = LoadRun(warehouse, {"order_feed": ORDER_FEED}, FunctionRegistry(), datetime.datetime(2024, 1, 1 + i), name)
        run.run([BUILD_ORDER_FEED])
    return warehouse


FEED_LOADED_SQL = FEED_SQL + """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, ordered FROM feed, newest
WHERE o_orderkey % 3 > 0 OR ordered IS NULL OR ordered >= newest.moment
"""


@query(FEED_LOADED_SQL)
def load_incremental_run(spark, sf_dir):
    return _feed_runs(spark, sf_dir).table(BUILD_ORDER_FEED.target)


@query(FEED_LOADED_SQL)
def load_append_repeated(spark, sf_dir):
    """The second run is done twice under its own name, as after a driver that was lost behind the write."""
    return _feed_runs(spark, sf_dir, ("run-0", "run-1", "run-1")).table(BUILD_ORDER_FEED.target)


@query(FEED_SQL + """,
     late AS (SELECT count(*) AS n FROM feed, newest WHERE o_orderkey % 3 = 0 AND ordered < newest.moment),
     fresh AS (SELECT count(*) AS n FROM feed, newest
               WHERE (o_orderkey % 3 > 0 AND ordered >= TIMESTAMP '1999-01-01')
                  OR (o_orderkey % 3 = 0 AND (ordered IS NULL OR ordered >= newest.moment))),
     late_again AS (SELECT count(*) AS n FROM feed WHERE o_orderkey % 3 = 0 AND ordered < (SELECT moment FROM newest))
SELECT 'run-1' AS run_id, 'D-rowcount-order_feed_loaded' AS check_id, 'PASS' AS status,
       'staging=' || n || ', target=' || n AS detail, CAST(0 AS BIGINT) AS n FROM fresh
UNION ALL SELECT 'run-1', 'D-late-order_feed_loaded', 'WARN',
       n || ' row(s) older than the newest loaded row, not appended', n FROM late
UNION ALL SELECT 'run-2', 'D-rowcount-order_feed_loaded', 'PASS', 'staging=0, target=0', 0
UNION ALL SELECT 'run-2', 'D-late-order_feed_loaded', 'WARN',
       n || ' row(s) older than the newest loaded row, not appended', n FROM late_again
""")
def dq_reconcile_incremental(spark, sf_dir):
    report = _feed_runs(spark, sf_dir).table(REPORT_TABLE)
    return report.where("run_id > 'run-0' AND (check_id LIKE 'D-rowcount-%' OR check_id LIKE 'D-late-%')").select(
        "run_id", "check_id", "status", "detail", "n")


@query("""
WITH changes AS (
  SELECT c_custkey, c_mktsegment, TIMESTAMP '2024-01-01' AS moment FROM customer
  UNION ALL SELECT c_custkey, 'FIRST', TIMESTAMP '2024-06-01' FROM customer WHERE c_custkey % 2 = 0
  UNION ALL SELECT c_custkey, 'SECOND', TIMESTAMP '2025-01-01' FROM customer WHERE c_custkey % 3 = 0)
SELECT c_custkey, c_mktsegment, md5(c_mktsegment) AS hashdiff, moment AS valid_from,
       lead(moment) OVER (PARTITION BY c_custkey ORDER BY moment) AS valid_to,
       lead(moment) OVER (PARTITION BY c_custkey ORDER BY moment) IS NULL AS is_current
FROM changes
""")
def load_scd2_multi_change(spark, sf_dir):
    """A batch with up to two changes of a key, one of them repeated later without a change."""
    customer = one(spark, sf_dir, "customer")

    def change(step: int, segment, moment: str):
        return customer.where(F.col("c_custkey") % step == 0).select(
            "c_custkey", F.lit(segment).alias("c_mktsegment") if segment else "c_mktsegment",
            F.lit(moment).cast("timestamp_ntz").alias("at"))
    keys, tracked = ["c_custkey"], ["c_mktsegment"]
    target = load.initial_versions(change(1, None, "2024-01-01"), keys, tracked, "at")
    batch = change(2, "FIRST", "2024-06-01").unionByName(change(3, "SECOND", "2025-01-01")).unionByName(
        change(3, "SECOND", "2025-06-01"))
    return load.apply_versions(target, batch, keys, tracked, "at")


CUSTOMER_FEED = TableSpec("raw", "customer_feed", (column("c_custkey", "BIGINT", pk=True), column("seen", "DATE")))
BUILD_NUMBERED = BuildSpec(
    TableSpec("analytics", "customer_numbered", (
        column("customer_key", "BIGINT", pk=True), column("customer_id", "BIGINT"), column("seen", "DATE"))),
    ("customer_feed",),
    (ColumnMapping("customer_key", SEQUENCE, order_by=("c_custkey",)), ColumnMapping("customer_id", DIRECT, "c_custkey"),
     ColumnMapping("seen", DIRECT, "seen")),
    "incremental", load_options={"keys": ["customer_id"], "timestamp": "seen"})


@query("""
WITH a AS (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS k FROM customer WHERE c_custkey % 3 > 0),
     b AS (SELECT c_custkey, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY c_custkey) AS k
           FROM customer WHERE c_custkey % 6 = 0)
SELECT k AS customer_key, c_custkey AS customer_id,
       CASE WHEN c_custkey % 2 = 0 THEN DATE '2025-01-01' ELSE DATE '2024-01-01' END AS seen
FROM (SELECT * FROM a UNION ALL SELECT * FROM b)
""")
def load_sequence_upsert(spark, sf_dir):
    """A second batch of known and new keys, each twice: only new keys are numbered, without gaps."""
    customer, warehouse = one(spark, sf_dir, "customer"), project(spark, sf_dir)
    day = lambda text: F.lit(text).cast("date").alias("seen")
    known = customer.where("c_custkey % 3 > 0").select("c_custkey", day("2024-01-01"))
    again = customer.where("c_custkey % 2 = 0")
    both = again.select("c_custkey", day("2025-01-01")).unionByName(again.select("c_custkey", day("2024-07-01")))
    for i, rows in enumerate((known, both)):
        warehouse.replace(CUSTOMER_FEED, rows)
        run = LoadRun(warehouse, {"customer_feed": CUSTOMER_FEED}, FunctionRegistry(), datetime.datetime(2024 + i, 1, 1), f"run-{i}")
        run.run([BUILD_NUMBERED], validate=False)
    return warehouse.table(BUILD_NUMBERED.target)


BUILD_FACT_EVENT = BuildSpec(
    TableSpec("analytics", "fact_event", (
        column("event_id", "BIGINT", pk=True), column("user_id", "BIGINT"), column("state", "TEXT"))),
    ("events",),
    (ColumnMapping("event_id", DIRECT, "event_id"), ColumnMapping("user_id", DIRECT, "user_id"),
     ColumnMapping("state", LOOKUP, lookup=Lookup(
         "dim_user_state", "event_type", (("user_id", "user_id"),), unknown_key="none", at="looked_at"))))


@query(f"""
WITH v AS ({HISTORY_SQL})
SELECT e.event_id, e.user_id, coalesce(v.event_type, 'none') AS state
FROM events e LEFT JOIN v ON v.user_id = e.user_id AND e.ts - INTERVAL 1 HOUR >= v.valid_from
                         AND (v.valid_to IS NULL OR e.ts - INTERVAL 1 HOUR < v.valid_to)
""")
def map_fact_versioned(spark, sf_dir):
    events = one(spark, sf_dir, "events").withColumn("looked_at", F.col("ts") - F.expr("INTERVAL 1 HOUR"))
    return build(BUILD_FACT_EVENT, {"events": events}, {"dim_user_state": history(spark, sf_dir)})


SEGMENTS = TableSpec("raw", "customer", (column("c_mktsegment", "TEXT", pk=True), column("c_name", "TEXT")))
BUILD_SEGMENT = BuildSpec(
    TableSpec("analytics", "segment_names", (column("segment", "TEXT", pk=True), column("full_name", "TEXT"))),
    ("customer",),
    (ColumnMapping("segment", DIRECT, "c_mktsegment"), ColumnMapping("full_name", UDF, ("c_name", "c_mktsegment"), udf="udf_full_name")))


@query("""
SELECT 'D-udf-segment_names.full_name' AS check_id, 'data' AS category, 'WARN' AS status,
       'no rows to check; ' || count(*) || ' row(s) without one source row of their key not compared' AS detail,
       CAST(0 AS BIGINT) AS n
FROM customer
""")
def dq_recompute_repeating_key(spark, sf_dir):
    """A declared source key that repeats: nothing can be compared, and the check must say so."""
    sources = read(spark, sf_dir, "customer")
    wrong = build(BUILD_SEGMENT, sources).withColumn("full_name", F.lit("wrong"))
    return reconcile.check_recomputed(BUILD_SEGMENT, SEGMENTS, wrong, sources)


BUILD_BROKEN = BuildSpec(
    TableSpec("analytics", "broken", (column("c_custkey", "BIGINT", pk=True), column("c_name", "TEXT"))), ("customer",),
    (ColumnMapping("c_custkey", DIRECT, "c_custkey"),
     ColumnMapping("c_name", EXPRESSION, expression="if(c_custkey >= 0, raise_error('first line\\nsecond line'), c_name)")))


@query("""
SELECT 1 AS seq, 'dim_customer' AS "table", 'read' AS stage, 'success' AS status, count(*) AS rows_affected,
       false AS whole_error FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 2, 'dim_customer', 'process', 'success', NULL, false
UNION ALL SELECT 3, 'dim_customer', 'write', 'success', count(*), false FROM customer WHERE c_acctbal >= 0
UNION ALL SELECT 4, 'broken', 'read', 'failure', NULL, true
""")
def load_failed_run_log(spark, sf_dir):
    """Steps that had ended when the run failed are in the log, and so is the whole text of the error."""
    warehouse = project(spark, sf_dir)
    run = LoadRun(warehouse, star.RAW_TABLES, FunctionRegistry(), star.RUN_TS, "run-1")
    try:
        run.run([star.BUILD_DIM_CUSTOMER_IN_CREDIT, BUILD_BROKEN])
    except StepFailed:
        pass
    whole = F.coalesce(F.col("error_message").contains("second line"), F.lit(False))
    return warehouse.table(LOG_TABLE).select(
        F.col("seq").cast("int").alias("seq"), "table", "stage", "status", "rows_affected", whole.alias("whole_error"))


@query("""
SELECT 'S-target-order_feed' AS check_id, 'schema' AS category, 'FAIL' AS status,
       'table ''order_feed'' not found in live target database' AS detail, CAST(1 AS BIGINT) AS n
UNION ALL SELECT 'D-rowcount-customer', 'data', 'PASS', 'staging=' || count(*) || ', target=' || count(*), 0 FROM customer
""")
def dq_missing_table(spark, sf_dir):
    customer = one(spark, sf_dir, "customer")
    return quality.union_checks([quality.check_schema(ORDER_FEED, None, spark),
                                 quality.check_row_count("customer", customer, customer)])


# --- reconciliation of batches --------------------------------------------------------


@query("""
WITH n AS (SELECT count(*) FILTER (c_acctbal < 8000) AS first, count(*) FILTER (c_acctbal >= 0) AS second,
                  count(*) FILTER (c_acctbal >= 0 AND (c_acctbal >= 8000 OR c_mktsegment = 'BUILDING')) AS changed FROM customer),
     runs AS (SELECT 'run-0' AS run_id, first AS staged, first AS opened FROM n
              UNION ALL SELECT 'run-1', second, changed FROM n)
SELECT run_id, 'D-rowcount-dim_customer_versions' AS check_id, 'PASS' AS status,
       'staging=' || staged || ', target=' || staged AS detail, CAST(0 AS BIGINT) AS n FROM runs
UNION ALL SELECT run_id, 'D-late-dim_customer_versions', 'PASS', 'no late rows', 0 FROM runs
UNION ALL SELECT run_id, 'D-udf-dim_customer_versions.customer_dk', 'PASS',
       '0/' || opened || ' row(s) mismatch re-invoking udf_generate_dk(...)', 0 FROM runs
UNION ALL SELECT run_id, 'D-udf-dim_customer_versions.hashdiff', 'PASS',
       '0/' || opened || ' row(s) mismatch re-invoking udf_hashdiff(...)', 0 FROM runs
""")
def dq_reconcile_scd2(spark, sf_dir):
    batches = [b.drop("seen_at") for b in customer_snapshots(spark, sf_dir)]
    warehouse = two_runs(spark, sf_dir, CUSTOMER_CHANGES, batches, [], BUILD_CUSTOMER_VERSIONS, validate=True)
    report = warehouse.table(REPORT_TABLE)
    return report.where("check_id RLIKE '^D-(rowcount|late|udf)-'").select("run_id", "check_id", "status", "detail", "n")


BUILD_CUSTOMER_NAMES = BuildSpec(
    TableSpec("analytics", "customer_names", (
        column("customer_bk", "TEXT", pk=True), column("full_name", "TEXT"), column("seen", "DATE"))), ("customer",),
    (ColumnMapping("customer_bk", UDF, "c_custkey", udf="udf_calculate_patient_bk"),
     ColumnMapping("full_name", UDF, ("c_name", "c_mktsegment"), udf="udf_full_name"),
     ColumnMapping("seen", EXPRESSION, expression="DATE'2024-01-01'")),
    "incremental", load_options={"keys": ["customer_bk"], "timestamp": "seen"})


@query("""
WITH n AS (SELECT count(*) AS batch, count(*) FILTER (c_custkey % 3 = 0) AS wrong FROM customer WHERE c_custkey % 4 = 0)
SELECT 'D-udf-customer_names.customer_bk' AS check_id, 'data' AS category, 'PASS' AS status,
       '0/' || batch || ' row(s) mismatch re-invoking udf_calculate_patient_bk(...)' AS detail, CAST(0 AS BIGINT) AS n FROM n
UNION ALL SELECT 'D-udf-customer_names.full_name', 'data', CASE WHEN wrong > 0 THEN 'FAIL' ELSE 'PASS' END,
       wrong || '/' || batch || ' row(s) mismatch re-invoking udf_full_name(...)', wrong FROM n
""")
def dq_recompute_function_key(spark, sf_dir):
    """A batch of every fourth customer, found in source and target by a function of the source's key."""
    sources = read(spark, sf_dir, "customer")
    staged = build(BUILD_CUSTOMER_NAMES, {"customer": sources["customer"].where("c_custkey % 4 = 0")})
    wrong = F.when(F.col("customer_bk").cast("long") % 3 == 0, "wrong").otherwise(F.col("full_name"))
    loaded = build(BUILD_CUSTOMER_NAMES, sources).withColumn("full_name", wrong)
    batch = loaded.join(staged.select("customer_bk"), "customer_bk", "left_semi")
    base = star.RAW_TABLES["customer"]
    reduced = reconcile.sources_of_batch(BUILD_CUSTOMER_NAMES, base, sources, staged, Mapper(BUILD_CUSTOMER_NAMES))
    return reconcile.check_recomputed(BUILD_CUSTOMER_NAMES, base, batch, reduced)


# --- records that cannot be read, tables that are not there, reset ----------------------

ORDER_TEXT = TableSpec("raw", "order_text", (
    column("o_orderkey", "BIGINT", pk=True), column("o_custkey", "BIGINT"), column("ordered", "DATE")))


def _ingested(spark, sf_dir, lines, format: str):
    """What became of the lines of a text file: rows of the source table, and the rejected texts."""
    warehouse, path = project(spark, sf_dir), fresh_path(spark, format, owned=True)
    one(spark, sf_dir, "orders").select(lines.alias("value")).write.text(path)
    report = ingest(warehouse, ORDER_TEXT, path, format)
    rejected = warehouse.table(f"staging.{rejected_table('order_text')}")
    told = report.select(F.concat_ws(" ", "check_id", "status", "detail").alias("text"))
    return (warehouse.table(ORDER_TEXT).withColumn("text", F.lit(None).cast("string"))
            .unionByName(rejected.select("text"), allowMissingColumns=True)
            .unionByName(told, allowMissingColumns=True))


@query("""
WITH lines AS (SELECT *, o_orderkey % 50 = 0 AS bad, CAST(o_orderdate AS DATE) AS ordered FROM orders)
SELECT o_orderkey, o_custkey, ordered, NULL::VARCHAR AS text FROM lines WHERE NOT bad
UNION ALL SELECT NULL, NULL, NULL, 'key ' || o_orderkey || ',' || o_custkey || ',' || ordered FROM lines WHERE bad
UNION ALL SELECT NULL, NULL, NULL, 'D-rejected-order_text WARN ' || count(*) || ' record(s) could not be read' FROM lines WHERE bad
""")
def source_csv_rejected(spark, sf_dir):
    """Every fiftieth line has a text where its number should be."""
    key = F.when(F.col("o_orderkey") % 50 == 0, F.concat(F.lit("key "), "o_orderkey")).otherwise(F.col("o_orderkey").cast("string"))
    return _ingested(spark, sf_dir, F.concat_ws(",", key, "o_custkey", F.to_date("o_orderdate")), "csv")


@query("""
WITH lines AS (SELECT *, o_orderkey % 40 = 0 AS bad, CAST(o_orderdate AS DATE) AS ordered FROM orders)
SELECT o_orderkey, o_custkey, ordered, NULL::VARCHAR AS text FROM lines WHERE NOT bad
UNION ALL SELECT NULL, NULL, NULL, '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"ordered":"' || ordered || '"'
FROM lines WHERE bad
UNION ALL SELECT NULL, NULL, NULL, 'D-rejected-order_text WARN ' || count(*) || ' record(s) could not be read' FROM lines WHERE bad
""")
def source_json_rejected(spark, sf_dir):
    """Every fortieth line ends before its closing brace."""
    line = F.to_json(F.struct("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("ordered")))
    cut = F.substring(line, F.lit(1), F.length(line) - F.when(F.col("o_orderkey") % 40 == 0, 1).otherwise(0))
    return _ingested(spark, sf_dir, cut, "json")


@query("""
SELECT 'S-source-customer' AS check_id, 'schema' AS category, 'FAIL' AS status,
       'table ''customer'' not found in live source database' AS detail, CAST(1 AS BIGINT) AS n
UNION ALL SELECT 'D-rowcount-orders', 'data', 'PASS', 'staging=' || count(*) || ', target=' || count(*), 0 FROM orders
""")
def dq_absent_table(spark, sf_dir):
    """A table that was there and is dropped: the check looks it up in the live namespace."""
    warehouse = project(spark, sf_dir)
    spark.sql(f"DROP TABLE {warehouse.name('raw.customer')}")
    orders = warehouse.find("raw.orders")
    return quality.union_checks([
        quality.check_schema(star.RAW_TABLES["customer"], warehouse.find("raw.customer"), spark, "source"),
        quality.check_row_count("orders", one(spark, sf_dir, "orders"), orders)])


@query("""
SELECT 'before' AS moment, true AS dimension, true AS staging, (SELECT count(*) FROM orders) AS orders
UNION ALL SELECT 'after', false, false, (SELECT count(*) FROM orders)
""")
def sink_reset(spark, sf_dir):
    """A reset of staging and analytics: their tables are gone, those of the source are untouched."""
    warehouse = project(spark, sf_dir)
    run = LoadRun(warehouse, star.RAW_TABLES, FunctionRegistry(), star.RUN_TS, "run-1")
    run.run([star.BUILD_DIM_CUSTOMER_IN_CREDIT], validate=False)
    spec = star.BUILD_DIM_CUSTOMER_IN_CREDIT

    def seen(moment: str):
        return warehouse.table("raw.orders").agg(F.count(F.lit(1)).alias("orders")).select(
            F.lit(moment).alias("moment"), F.lit(warehouse.exists(spec.target)).alias("dimension"),
            F.lit(warehouse.exists(f"staging.{spec.staging_table}")).alias("staging"), "orders")
    before = seen("before")
    warehouse.reset(["staging", "analytics"])
    return before.unionByName(seen("after"))
