"""The queries of the star schema over the test tables, each with its SQL equivalent.

The test tables have no NULLs, no orphans and few duplicates, so a query that
checks something first spoils what it checks: customers in debt are left out of
a dimension, a status or priority is read as NULL, a segment is renamed.  Every
query reads its tables whole.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from starload.functions import library as lib
from starload.functions.registry import FunctionRegistry, register_sql_functions
from starload.operators import load, quality, runlog
from starload.operators.lookup import lookup_as_of
from starload.plans import reconcile, star
from starload.plans.build import build
from starload.plans.load import LOG_TABLE, LoadRun
from starload.scratch import fresh_path
from starload.sources import readers
from starload.sources.warehouse import Warehouse
from starload.spec import (
    CONSTANT, DIRECT, EXPRESSION, LOOKUP, RUN_TIMESTAMP, UDF, BuildSpec, Call, ColumnMapping, Lookup, TableSpec, column,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql.strip()
        return function
    return register


def read(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: readers.read_parquet(spark, f"{sf_dir}/{n}.parquet") for n in names}


def one(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read(spark, sf_dir, name)[name]


# --- column mappings ----------------------------------------------------------------


@query("""
SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id,
       trim(coalesce(c_name, '') || ' ' || coalesce(c_mktsegment, '')) AS full_name,
       c_nationkey AS nation_id, 'TPCH' AS source_system
FROM customer
""")
def map_dim_customer(spark, sf_dir):
    return build(star.BUILD_DIM_CUSTOMER, read(spark, sf_dir, "customer"))


def _dim_customer_in_credit(spark, sf_dir):
    return build(star.BUILD_DIM_CUSTOMER_IN_CREDIT, read(spark, sf_dir, "customer"))


DIM_CUSTOMER_SQL = """
  SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id
  FROM customer WHERE c_acctbal >= 0
"""


@query(f"""
WITH dim AS ({DIM_CUSTOMER_SQL})
SELECT row_number() OVER (ORDER BY o_orderkey) AS order_key, o_orderkey AS order_id, dim.customer_key,
       o_orderstatus AS status, CAST(o_totalprice AS DECIMAL(12,2)) AS total_price,
       CAST(o_orderdate AS DATE) AS order_date
FROM orders LEFT JOIN dim ON dim.customer_id = orders.o_custkey
""")
def map_fact_order_lookup(spark, sf_dir):
    return build(star.BUILD_FACT_ORDER, read(spark, sf_dir, "orders"),
                 {"dim_customer": _dim_customer_in_credit(spark, sf_dir)})


@query("""
WITH dim_part AS (SELECT row_number() OVER (ORDER BY p_partkey) AS part_key, p_partkey FROM part),
     dim_supplier AS (SELECT row_number() OVER (ORDER BY s_suppkey) AS supplier_key, s_suppkey
                      FROM supplier WHERE s_acctbal >= 0)
SELECT l_orderkey AS order_id, l_linenumber AS line_number, part_key,
       coalesce(supplier_key, -1) AS supplier_key, CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
       CAST(l_shipdate AS DATE) AS ship_date
FROM lineitem LEFT JOIN dim_part ON p_partkey = l_partkey LEFT JOIN dim_supplier ON s_suppkey = l_suppkey
""")
def map_fact_lineitem(spark, sf_dir):
    dimensions = {
        "dim_part": build(star.BUILD_DIM_PART, read(spark, sf_dir, "part")),
        "dim_supplier": build(star.BUILD_DIM_SUPPLIER_IN_CREDIT, read(spark, sf_dir, "supplier")),
    }
    return build(star.BUILD_FACT_LINEITEM, read(spark, sf_dir, "lineitem"), dimensions)


@query("""
SELECT o_orderkey AS order_id, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS order_date
FROM orders WHERE o_orderstatus = 'F'
""")
def map_filtered(spark, sf_dir):
    return build(star.BUILD_FINISHED_ORDERS, read(spark, sf_dir, "orders"))


@query("""
SELECT l_orderkey AS order_id, l_linenumber AS line_number,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            AS DECIMAL(18,2)) AS revenue
FROM lineitem
""")
def map_expression(spark, sf_dir):
    return build(star.BUILD_REVENUE, read(spark, sf_dir, "lineitem"))


@query("""
SELECT o_orderkey AS order_id, coalesce(nullif(o_orderstatus, 'P'), 'UNKNOWN') AS status, 'BATCH' AS channel
FROM orders
""")
def map_default(spark, sf_dir):
    orders = one(spark, sf_dir, "orders")
    spoiled = orders.withColumn("known_status", F.nullif("o_orderstatus", F.lit("P")))
    return build(star.BUILD_ORDER_STATUS, {"orders": spoiled})


@query("""
WITH existing AS (SELECT row_number() OVER (ORDER BY c_custkey) AS customer_key, c_custkey AS customer_id
                  FROM customer WHERE c_mktsegment = 'BUILDING')
SELECT * FROM existing
UNION ALL
SELECT row_number() OVER (ORDER BY c_custkey) + (SELECT max(customer_key) FROM existing), c_custkey
FROM customer WHERE c_mktsegment <> 'BUILDING'
""")
def map_sequence_continue(spark, sf_dir):
    customer = one(spark, sf_dir, "customer")
    sequence = star.BUILD_NEW_CUSTOMERS
    earlier = BuildSpec(sequence.target, sequence.source_tables, sequence.columns,
                        filters=("c_mktsegment = 'BUILDING'",))
    existing = build(earlier, {"customer": customer})
    return existing.unionByName(build(sequence, {"customer": customer}, existing=existing))


@query(r"""
SELECT regexp_replace(md5(CAST(c_custkey AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$',
                      '\1-\2-\3-\4-\5') AS customer_uuid, c_custkey AS customer_id
FROM customer
""")
def map_uuid(spark, sf_dir):
    return build(star.BUILD_CUSTOMER_UUID, read(spark, sf_dir, "customer"))


@query("""
SELECT c_custkey AS customer_id, n_name AS nation, r_name AS region
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def map_joined_sources(spark, sf_dir):
    return build(star.BUILD_CUSTOMER_GEOGRAPHY, read(spark, sf_dir, "customer", "nation", "region"))


@query("""
SELECT p_partkey AS part_id, CAST(substring(p_brand, 7) AS INTEGER) AS brand_number,
       TRY_CAST(p_type AS INTEGER) AS type_number, CAST(p_size AS SMALLINT) AS size,
       CAST(p_retailprice AS DECIMAL(10,2)) AS retail_price
FROM part
""")
def map_typed(spark, sf_dir):
    return build(star.BUILD_PART_TYPED, read(spark, sf_dir, "part"))


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS customer_bk,
       md5(CAST(c_custkey AS VARCHAR) || '|2026-01-01 00:00:00.000000') AS customer_dk,
       md5(CAST(c_custkey AS VARCHAR) || '|2026-01-01 00:00:00.000000') AS customer_dk_sql,
       TIMESTAMP '2026-01-01 00:00:00' AS _loaded_at
FROM customer
""")
def map_composed_call(spark, sf_dir):
    register_sql_functions(spark)
    return build(star.BUILD_CUSTOMER_VERSION_KEY, read(spark, sf_dir, "customer"), run_timestamp=star.RUN_TS)


# --- functions ----------------------------------------------------------------------


@query("""
SELECT o_orderkey, CAST(date_part('year', age(DATE '1998-06-15', CAST(o_orderdate AS DATE))) AS INTEGER) AS age
FROM orders
""")
def udf_age(spark, sf_dir):
    return one(spark, sf_dir, "orders").select(
        "o_orderkey", lib.calculate_age(F.col("o_orderdate"), star.AS_OF).alias("age"))


@query("""
SELECT c_custkey, nullif(lower(trim(' ' || replace(c_name, '#', '.') || '@' || c_mktsegment || '.Example ')), '') AS email,
       nullif(regexp_replace('+' || c_nationkey || ' (0) ' || c_name, '[^0-9]', '', 'g'), '') AS phone,
       nullif(regexp_replace(c_mktsegment, '[^0-9]', '', 'g'), '') AS no_phone
FROM customer
""")
def udf_clean_contact(spark, sf_dir):
    customer = one(spark, sf_dir, "customer")
    email = F.concat(F.lit(" "), F.replace("c_name", F.lit("#"), F.lit(".")), F.lit("@"),
                     F.col("c_mktsegment"), F.lit(".Example "))
    phone = F.concat(F.lit("+"), F.col("c_nationkey").cast("string"), F.lit(" (0) "), F.col("c_name"))
    return customer.select("c_custkey", lib.clean_email(email).alias("email"),
                           lib.clean_phone(phone).alias("phone"),
                           lib.clean_phone(F.col("c_mktsegment")).alias("no_phone"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey,
       CASE l_returnflag WHEN 'R' THEN true WHEN 'N' THEN false END AS returned,
       CASE l_linestatus WHEN 'Y' THEN true WHEN 'N' THEN false END AS flagged
FROM lineitem
""")
def udf_flag(spark, sf_dir):
    return one(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        lib.yes_no(F.concat(F.lower("l_returnflag"), F.lit(" ")), "R", "N").alias("returned"),
        lib.flag_to_boolean(F.col("l_linestatus")).alias("flagged"))


@query("""
SELECT event_id, CAST(try_strptime(CASE WHEN event_type = 'error' THEN 'bad'
       WHEN event_type = 'view' THEN strftime(ts, '%Y-%m-') || '45' ELSE strftime(ts, '%Y-%m-%d') END,
       '%Y-%m-%d') AS DATE) AS event_date
FROM events
""")
def udf_parse_date(spark, sf_dir):
    raw = (F.when(F.col("event_type") == "error", "bad")
           .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-'45'"))
           .otherwise(F.date_format("ts", "yyyy-MM-dd")))
    return one(spark, sf_dir, "events").select("event_id", lib.parse_date(raw).alias("event_date"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN strftime(ts, '%H:%M:%S')
       ELSE strftime(ts, '%H:%M') || ':00' END AS event_time
FROM events
""")
def udf_parse_time(spark, sf_dir):
    raw = (F.when(F.col("event_type") == "error", F.date_format("ts", "HH-mm"))
           .when(F.col("event_type") == "view", F.date_format("ts", "H:mm:ss"))
           .when(F.col("event_type") == "click", F.date_format("ts", "H:mm"))
           .otherwise(F.date_format("ts", " HH:mm ")))
    return one(spark, sf_dir, "events").select("event_id", lib.parse_time(raw).alias("event_time"))


@query("""
SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS customer_bk, c_custkey || '|' || c_name AS doctor_bk,
       c_custkey || '|' || nullif(c_mktsegment, 'BUILDING') AS partial_bk,
       md5(c_custkey || '|2026-01-01 00:00:00.000000') AS customer_dk
FROM customer
""")
def udf_business_keys(spark, sf_dir):
    key = F.col("c_custkey")
    moment = F.lit(star.RUN_TS.isoformat(" ")).cast("timestamp_ntz")
    return one(spark, sf_dir, "customer").select(
        "c_custkey", lib.business_key(key).alias("customer_bk"),
        lib.business_key(key, F.col("c_name")).alias("doctor_bk"),
        lib.business_key(key, F.nullif("c_mktsegment", F.lit("BUILDING"))).alias("partial_bk"),
        lib.domain_key(lib.business_key(key), moment).alias("customer_dk"))


@query(r"""
SELECT c_custkey, md5(concat_ws('|', c_name, coalesce(nullif(c_mktsegment, 'BUILDING'), '\N'),
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR))) AS hashdiff
FROM customer
""")
def udf_hashdiff(spark, sf_dir):
    return one(spark, sf_dir, "customer").select("c_custkey", lib.hashdiff(
        F.col("c_name"), F.nullif("c_mktsegment", F.lit("BUILDING")),
        F.col("c_acctbal").cast("decimal(12,2)")).alias("hashdiff"))


@query("SELECT doc_id, 'sha256:' || sha256(text) AS text_hash FROM documents")
def udf_text_hash(spark, sf_dir):
    return one(spark, sf_dir, "documents").select("doc_id", lib.text_hash(F.col("text")).alias("text_hash"))


@query("""
SELECT c_custkey, trim(c_name || ' ' || c_mktsegment) AS full_name, c_name || '|' || c_mktsegment AS bk,
       lower(trim(c_name)) AS email, CASE c_mktsegment WHEN 'Y' THEN true WHEN 'N' THEN false END AS flag
FROM customer
""")
def udf_sql_functions(spark, sf_dir):
    register_sql_functions(spark)
    return one(spark, sf_dir, "customer").selectExpr(
        "c_custkey", "udf_full_name(c_name, c_mktsegment) AS full_name",
        "udf_calculate_doctor_bk(c_name, c_mktsegment) AS bk",
        "udf_clean_email(c_name) AS email", "udf_flag_to_boolean(c_mktsegment) AS flag")


# --- sources and sinks --------------------------------------------------------------


@query("SELECT * FROM orders")
def source_csv_typed(spark, sf_dir):
    path = fresh_path(spark, "orders-csv", owned=True)
    one(spark, sf_dir, "orders").write.csv(path, header=True)
    return readers.read_csv(spark, path, star.ORDERS)


@query("SELECT * FROM events")
def source_json_typed(spark, sf_dir):
    path = fresh_path(spark, "events-json", owned=True)
    one(spark, sf_dir, "events").write.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").json(path)
    return readers.read_json(spark, path, star.EVENTS)


def project(spark: SparkSession, sf_dir: str) -> Warehouse:
    """A warehouse of its own with the raw tables attached."""
    root = fresh_path(spark, "project", owned=True)
    warehouse = Warehouse(spark, root, prefix=f"p{root[-12:]}_")
    warehouse.create_namespaces()
    for name in star.RAW_TABLES:
        warehouse.attach(f"raw.{name}", f"{sf_dir}/{name}.parquet")
    return warehouse


@query("""
SELECT o_orderkey AS order_id, coalesce(nullif(o_orderstatus, 'P'), 'UNKNOWN') AS status, 'BATCH' AS channel
FROM orders
""")
def sink_reset_reload(spark, sf_dir):
    warehouse = project(spark, sf_dir)
    spec = star.BUILD_ORDER_STATUS
    rows = map_default(spark, sf_dir)
    warehouse.write_staging(spec.staging_table, rows)
    warehouse.replace(spec.target, warehouse.table(f"staging.{spec.staging_table}"))
    warehouse.truncate(spec.target)
    warehouse.append(spec.target, warehouse.table(f"staging.{spec.staging_table}"))
    warehouse.drop_staging(spec.staging_table)
    return warehouse.table(spec.target)


def _star_run(spark, sf_dir):
    run = LoadRun(project(spark, sf_dir), star.RAW_TABLES, FunctionRegistry(), star.RUN_TS, "run-1")
    return run, run.run([star.BUILD_DIM_CUSTOMER_IN_CREDIT, star.BUILD_FACT_ORDER])


@query(f"""
WITH dim AS ({DIM_CUSTOMER_SQL})
SELECT o_orderkey AS order_id, dim.customer_key, CAST(o_totalprice AS DECIMAL(12,2)) AS total_price
FROM orders LEFT JOIN dim ON dim.customer_id = orders.o_custkey
""")
def load_star(spark, sf_dir):
    run = LoadRun(project(spark, sf_dir), star.RAW_TABLES, FunctionRegistry(), star.RUN_TS, "run-1")
    run.run([star.BUILD_DIM_CUSTOMER_IN_CREDIT, star.BUILD_FACT_ORDER], validate=False)
    return run.warehouse.table(star.BUILD_FACT_ORDER.target).select("order_id", "customer_key", "total_price")


@query("""
WITH n AS (SELECT (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS dim, (SELECT count(*) FROM orders) AS fact,
  (SELECT count(*) FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal < 0) AS lost)
SELECT unnest([
  {'check_id': 'D-rowcount-dim_customer', 'status': 'WARN', 'n': 0::BIGINT, 'detail': 'staging=' || dim || ', target=' || dim || ' (buildspec declares filter(s), exact match not asserted)'},
  {'check_id': 'D-duplicates-dim_customer', 'status': 'PASS', 'n': 0, 'detail': '(customer_key) unique'},
  {'check_id': 'D-notnull-dim_customer.customer_key', 'status': 'PASS', 'n': 0, 'detail': 'no NULLs'},
  {'check_id': 'D-notnull-dim_customer.customer_id', 'status': 'PASS', 'n': 0, 'detail': 'no NULLs'},
  {'check_id': 'D-notnull-dim_customer.source_system', 'status': 'PASS', 'n': 0, 'detail': 'no NULLs'},
  {'check_id': 'D-udf-dim_customer.full_name', 'status': 'PASS', 'n': 0, 'detail': '0/' || dim || ' row(s) mismatch re-invoking udf_full_name(...)'},
  {'check_id': 'D-rowcount-fact_order', 'status': 'PASS', 'n': 0, 'detail': 'staging=' || fact || ', target=' || fact},
  {'check_id': 'D-grain-fact_order', 'status': 'PASS', 'n': 0, 'detail': '(order_id) unique'},
  {'check_id': 'D-duplicates-fact_order', 'status': 'PASS', 'n': 0, 'detail': '(order_key) unique'},
  {'check_id': 'D-notnull-fact_order.order_key', 'status': 'PASS', 'n': 0, 'detail': 'no NULLs'},
  {'check_id': 'D-notnull-fact_order.order_id', 'status': 'PASS', 'n': 0, 'detail': 'no NULLs'},
  {'check_id': 'D-notnull-fact_order.customer_key', 'status': 'FAIL', 'n': lost, 'detail': lost || ' unexpected NULL(s) in NOT NULL column'},
  {'check_id': 'D-fk-fact_order.customer_key', 'status': 'PASS', 'n': 0, 'detail': 'all customer_key values resolve to dim_customer.customer_key'}
], recursive := true) FROM n
""")
def load_star_report(spark, sf_dir):
    _, report = _star_run(spark, sf_dir)
    return report.where("category = 'data'").select("check_id", "status", "detail", "n")


@query("""
WITH n AS (SELECT (SELECT count(*) FROM customer WHERE c_acctbal >= 0) AS dim, (SELECT count(*) FROM orders) AS fact)
SELECT unnest([
  {'run_id': 'run-1', 'seq': 1::BIGINT, 'table': 'dim_customer', 'stage': 'read', 'status': 'success', 'rows_affected': dim},
  {'run_id': 'run-1', 'seq': 2, 'table': 'dim_customer', 'stage': 'process', 'status': 'success', 'rows_affected': NULL},
  {'run_id': 'run-1', 'seq': 3, 'table': 'dim_customer', 'stage': 'write', 'status': 'success', 'rows_affected': dim},
  {'run_id': 'run-1', 'seq': 4, 'table': 'fact_order', 'stage': 'read', 'status': 'success', 'rows_affected': fact},
  {'run_id': 'run-1', 'seq': 5, 'table': 'fact_order', 'stage': 'process', 'status': 'success', 'rows_affected': NULL},
  {'run_id': 'run-1', 'seq': 6, 'table': 'fact_order', 'stage': 'write', 'status': 'success', 'rows_affected': fact}
], recursive := true) FROM n
""")
def load_star_log(spark, sf_dir):
    run = LoadRun(project(spark, sf_dir), star.RAW_TABLES, FunctionRegistry(), star.RUN_TS, "run-1")
    run.run([star.BUILD_DIM_CUSTOMER_IN_CREDIT, star.BUILD_FACT_ORDER], validate=False)
    return run.warehouse.table(LOG_TABLE).select("run_id", "seq", "table", "stage", "status", "rows_affected")


@query("""
SELECT 'D-fk-orders.o_custkey' AS check_id, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status, n,
       DATE '2026-01-01' AS run_date
FROM (SELECT count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey WHERE c_acctbal < 0)
""")
def sink_report(spark, sf_dir):
    warehouse = project(spark, sf_dir)
    report = dq_fk_orphans(spark, sf_dir).withColumn("run_date", F.lit("2026-01-01").cast("date"))
    warehouse.append_report("analytics.dq_report", report, ["run_date"])
    return warehouse.table("analytics.dq_report").select("check_id", "status", "n", "run_date")


# --- load strategies ----------------------------------------------------------------

ORDER_LOAD = TableSpec("analytics", "order_load", (
    column("o_orderkey", "BIGINT", pk=True),
    column("o_custkey", "BIGINT"),
    column("o_orderdate", "TIMESTAMP"),
    column("batch", "VARCHAR(10)"),
))


@query("""
SELECT o_orderkey, o_custkey, o_orderdate,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'initial' ELSE 'increment' END AS batch
FROM orders
""")
def load_incremental_append(spark, sf_dir):
    orders = one(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    warehouse = project(spark, sf_dir)
    warehouse.append(ORDER_LOAD, orders.where("o_orderdate < timestamp_ntz'1998-01-01'")
                     .withColumn("batch", F.lit("initial")))
    target = warehouse.table(ORDER_LOAD)
    warehouse.append(ORDER_LOAD, load.newer_rows(orders, target, "o_orderdate")
                     .withColumn("batch", F.lit("increment")))
    return warehouse.table(ORDER_LOAD)


def _upsert_input(spark, sf_dir):
    """Orders up to 1998 as target; those from 1997 on as a batch that holds each row twice."""
    orders = one(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", 10).otherwise(0)
    target = (orders.where("o_orderdate < timestamp_ntz'1999-01-01'")
              .withColumn("updated", F.date_add(F.to_date("o_orderdate"), urgent)))
    late = orders.where("o_orderdate >= timestamp_ntz'1997-01-01'").drop("o_orderstatus")
    batch = [late.select("o_orderkey", F.lit(status).alias("o_orderstatus"), "o_orderdate", "o_orderpriority",
                         F.date_add(F.to_date("o_orderdate"), days).alias("updated"))
             for status, days in (("X", 1), ("Y", 5))]
    return target, batch[0].unionByName(batch[1])


UPSERT_SQL = """
WITH t AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority,
         CAST(o_orderdate AS DATE) + CASE WHEN o_orderpriority = '1-URGENT' THEN 10 ELSE 0 END AS updated, 1 AS side
  FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'
  UNION ALL
  SELECT o_orderkey, 'Y', o_orderdate, o_orderpriority, CAST(o_orderdate AS DATE) + 5, 2
  FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
  UNION ALL
  SELECT o_orderkey, 'X', o_orderdate, o_orderpriority, CAST(o_orderdate AS DATE) + 1, 2
  FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01')
SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority, CAST(updated AS DATE) AS updated FROM t
QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY updated DESC, side DESC) = 1
"""


@query(UPSERT_SQL)
def load_upsert(spark, sf_dir):
    target, batch = _upsert_input(spark, sf_dir)
    return load.upsert(target, batch, ["o_orderkey"], "updated")


ORDER_STATE = TableSpec("analytics", "order_state", (
    column("order_id", "BIGINT", pk=True), column("status", "VARCHAR(1)"), column("customer_key", "BIGINT"),
    column("updated", "DATE"), column("order_year", "INT")), partition_by=("order_year",))
ORDER_CHANGES = TableSpec("raw", "order_changes", (
    column("o_orderkey", "BIGINT", pk=True), column("o_custkey", "BIGINT"), column("o_orderstatus", "VARCHAR(1)"),
    column("o_orderdate", "TIMESTAMP"), column("updated", "DATE")))
BUILD_ORDER_STATE = BuildSpec(
    ORDER_STATE, ("order_changes",),
    (ColumnMapping("order_id", DIRECT, "o_orderkey"), ColumnMapping("status", DIRECT, "o_orderstatus"),
     ColumnMapping("customer_key", LOOKUP, lookup=Lookup(
         "dim_customer", "customer_key", (("o_custkey", "customer_id"),), unknown_key=-1)),
     ColumnMapping("updated", DIRECT, "updated"),
     ColumnMapping("order_year", EXPRESSION, expression="year(o_orderdate)")),
    "incremental", load_options={"keys": ["order_id"], "timestamp": "updated"})


def two_runs(spark, sf_dir, changes: TableSpec, batches, parents, spec, *, validate: bool = False):
    """A warehouse after one run per batch of changes."""
    warehouse = project(spark, sf_dir)
    for i, batch in enumerate(batches):
        warehouse.replace(changes, batch)
        run = LoadRun(warehouse, {**star.RAW_TABLES, changes.name: changes}, FunctionRegistry(),
                      datetime.datetime(2024 + i, 1, 1), f"run-{i}")
        run.run([*(parents if i == 0 else []), spec], validate=validate)
    return warehouse


@query(f"""
WITH s AS ({UPSERT_SQL}), dim AS ({DIM_CUSTOMER_SQL})
SELECT s.o_orderkey AS order_id, s.o_orderstatus AS status, coalesce(dim.customer_key, -1) AS customer_key, s.updated,
       CAST(year(s.o_orderdate) AS INTEGER) AS order_year
FROM s JOIN orders USING (o_orderkey) LEFT JOIN dim ON dim.customer_id = orders.o_custkey
""")
def load_upsert_partitions(spark, sf_dir):
    owners = one(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    batches = [b.join(owners, "o_orderkey") for b in _upsert_input(spark, sf_dir)]
    warehouse = two_runs(spark, sf_dir, ORDER_CHANGES, batches, [star.BUILD_DIM_CUSTOMER_IN_CREDIT], BUILD_ORDER_STATE)
    return warehouse.table(ORDER_STATE)


SEGMENT_CHANGE_SQL = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'CONSTRUCTION' ELSE c_mktsegment END"


def customer_snapshots(spark, sf_dir):
    """Customers below 8000 in 2024; all but those in debt in 2025, a segment renamed."""
    customer = one(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal")
    renamed = F.when(F.col("c_mktsegment") == "BUILDING", "CONSTRUCTION").otherwise(F.col("c_mktsegment"))
    ts = lambda text: F.lit(text).cast("timestamp_ntz")
    first = customer.where("c_acctbal < 8000").withColumn("seen_at", ts("2024-01-01"))
    second = (customer.where("c_acctbal >= 0").withColumn("c_mktsegment", renamed)
              .withColumn("seen_at", ts("2025-01-01")))
    return first.drop("c_acctbal"), second.drop("c_acctbal")


SCD2_SQL = f"""
  SELECT c_custkey, c_name, c_mktsegment, TIMESTAMP '2024-01-01' AS valid_from,
         CASE WHEN c_acctbal >= 0 AND c_mktsegment = 'BUILDING' THEN TIMESTAMP '2025-01-01' END AS valid_to
  FROM customer WHERE c_acctbal < 8000
  UNION ALL
  SELECT c_custkey, c_name, {SEGMENT_CHANGE_SQL}, TIMESTAMP '2025-01-01', NULL
  FROM customer WHERE c_acctbal >= 0 AND (c_acctbal >= 8000 OR c_mktsegment = 'BUILDING')
"""


@query(f"""
SELECT c_custkey, c_name, c_mktsegment, md5(c_name || '|' || c_mktsegment) AS hashdiff, valid_from, valid_to,
       valid_to IS NULL AS is_current
FROM ({SCD2_SQL})
""")
def load_scd2_batch(spark, sf_dir):
    first, second = customer_snapshots(spark, sf_dir)
    keys, tracked = ["c_custkey"], ["c_name", "c_mktsegment"]
    target = load.initial_versions(first, keys, tracked, "seen_at")
    return load.apply_versions(target, second, keys, tracked, "seen_at")


CUSTOMER_CHANGES = TableSpec("raw", "customer_changes", (
    column("c_custkey", "BIGINT", pk=True), column("c_name", "TEXT"), column("c_mktsegment", "TEXT")))
BUILD_CUSTOMER_VERSIONS = BuildSpec(
    TableSpec("analytics", "dim_customer_versions", (
        column("customer_dk", "VARCHAR(32)", pk=True), column("c_custkey", "BIGINT", nullable=False),
        column("c_name", "VARCHAR(50)"), column("c_mktsegment", "VARCHAR(20)"), column("hashdiff", "VARCHAR(32)"),
        column("valid_from", "TIMESTAMP", nullable=False), column("valid_to", "TIMESTAMP"),
        column("is_current", "BOOLEAN", nullable=False)), bucket_by=("c_custkey",), buckets=8),
    ("customer_changes",),
    (ColumnMapping("customer_dk", UDF, udf=Call("udf_generate_dk", (
        Call("udf_calculate_patient_bk", ("c_custkey",)), RUN_TIMESTAMP))),
     *[ColumnMapping(c, DIRECT, c) for c in ("c_custkey", "c_name", "c_mktsegment")],
     ColumnMapping("hashdiff", UDF, ("c_name", "c_mktsegment"), udf="udf_hashdiff"),
     ColumnMapping("valid_from", CONSTANT, value=RUN_TIMESTAMP), ColumnMapping("valid_to", CONSTANT),
     ColumnMapping("is_current", CONSTANT, value=True)),
    "scd2", load_options={"keys": ["c_custkey"], "tracked": ["c_name", "c_mktsegment"]})


@query(f"""
SELECT md5(c_custkey || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS customer_dk, c_custkey, c_name,
       c_mktsegment, md5(c_name || '|' || c_mktsegment) AS hashdiff, valid_from, valid_to, valid_to IS NULL AS is_current
FROM ({SCD2_SQL})
""")
def load_scd2_run(spark, sf_dir):
    batches = [b.drop("seen_at") for b in customer_snapshots(spark, sf_dir)]
    warehouse = two_runs(spark, sf_dir, CUSTOMER_CHANGES, batches, [], BUILD_CUSTOMER_VERSIONS)
    return warehouse.table(BUILD_CUSTOMER_VERSIONS.target)


@query(f"""
SELECT change, count(*) AS n FROM (
  SELECT CASE WHEN c_acctbal >= 8000 THEN 'new' WHEN c_acctbal < 0 THEN 'missing'
              WHEN c_mktsegment = 'BUILDING' THEN 'changed' ELSE 'unchanged' END AS change FROM customer)
GROUP BY change
""")
def load_scd2_changes(spark, sf_dir):
    first, second = customer_snapshots(spark, sf_dir)
    keys, tracked = ["c_custkey"], ["c_name", "c_mktsegment"]
    target = load.initial_versions(first, keys, tracked, "seen_at")
    return load.compare_versions(target, second, keys, tracked, "seen_at").groupBy("change").agg(
        F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_custkey, c_name, 'CONSTRUCTION' AS c_mktsegment, TIMESTAMP '2023-01-01' AS seen_at
FROM customer WHERE c_acctbal >= 0 AND c_acctbal < 8000 AND c_mktsegment = 'BUILDING'
""")
def load_scd2_late(spark, sf_dir):
    first, second = customer_snapshots(spark, sf_dir)
    keys, tracked = ["c_custkey"], ["c_name", "c_mktsegment"]
    target = load.initial_versions(first, keys, tracked, "seen_at")
    old = second.withColumn("seen_at", F.lit("2023-01-01").cast("timestamp_ntz"))
    return load.late_rows(target, old, keys, tracked, "seen_at")


HISTORY_SQL = """
  SELECT user_id, event_type, md5(event_type) AS hashdiff, ts AS valid_from,
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to
  FROM (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM events)
  WHERE before IS DISTINCT FROM event_type
"""


def history(spark, sf_dir):
    return load.version_history(one(spark, sf_dir, "events"), ["user_id"], ["event_type"], ["ts", "event_id"])


@query(f"SELECT *, valid_to IS NULL AS is_current FROM ({HISTORY_SQL})")
def load_scd2_history(spark, sf_dir):
    return history(spark, sf_dir)


@query(f"""
WITH v AS ({HISTORY_SQL}), f AS (SELECT event_id, user_id, ts - INTERVAL 1 HOUR AS looked_at, value FROM events)
SELECT f.*, v.event_type AS state, v.valid_from AS since
FROM f LEFT JOIN v ON v.user_id = f.user_id AND f.looked_at >= v.valid_from
                  AND (v.valid_to IS NULL OR f.looked_at < v.valid_to)
""")
def lookup_scd2_asof(spark, sf_dir):
    facts = one(spark, sf_dir, "events").select(
        "event_id", "user_id", (F.col("ts") - F.expr("INTERVAL 1 HOUR")).alias("looked_at"), "value")
    return lookup_as_of(facts, history(spark, sf_dir), [("user_id", "user_id")], "looked_at",
                        {"state": "event_type", "since": "valid_from"})


# --- data quality -------------------------------------------------------------------


@query("""
SELECT 'D-rowcount-orders' AS check_id, 'data' AS category, CASE WHEN s = t THEN 'PASS' ELSE 'FAIL' END AS status,
       'staging=' || s || ', target=' || t AS detail, abs(s - t) AS n
FROM (SELECT count(*) AS s, count(*) FILTER (o_totalprice >= 5000) AS t FROM orders)
""")
def dq_rowcount(spark, sf_dir):
    orders = one(spark, sf_dir, "orders")
    return quality.check_row_count("orders", orders, orders.where("o_totalprice >= 5000"))


@query("""
SELECT 'D-duplicates-lineitem' AS check_id, 'data' AS category, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
       CASE WHEN n > 0 THEN n || ' duplicate primary-key group(s) on (l_orderkey, l_linenumber)'
            ELSE '(l_orderkey, l_linenumber) unique' END AS detail, n
FROM (SELECT count(*) AS n FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1))
""")
def dq_pk_duplicates(spark, sf_dir):
    return quality.check_unique("lineitem", one(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def dq_duplicate_groups(spark, sf_dir):
    return quality.duplicate_groups(one(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


NOT_NULL_SQL = """
  SELECT unnest(['o_orderkey', 'o_orderstatus', 'o_orderpriority']) AS c,
         unnest([count(*) FILTER (o_orderkey IS NULL), count(*) FILTER (nullif(o_orderstatus, 'P') IS NULL),
                 count(*) FILTER (nullif(o_orderpriority, '5-LOW') IS NULL)]) AS n
  FROM orders
"""


@query(f"""
SELECT 'D-notnull-orders.' || c AS check_id, 'data' AS category, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
       CASE WHEN n > 0 THEN n || ' unexpected NULL(s) in NOT NULL column' ELSE 'no NULLs' END AS detail, n
FROM ({NOT_NULL_SQL})
""")
def dq_not_null(spark, sf_dir):
    spoiled = one(spark, sf_dir, "orders").withColumns({
        "o_orderstatus": F.nullif("o_orderstatus", F.lit("P")),
        "o_orderpriority": F.nullif("o_orderpriority", F.lit("5-LOW"))})
    return quality.check_not_null("orders", spoiled, ["o_orderkey", "o_orderstatus", "o_orderpriority"])


FK_SQL = """
  SELECT count(*) AS n FROM orders o WHERE o.o_custkey IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey AND c.c_acctbal >= 0)
"""


@query(f"""
SELECT 'D-fk-orders.o_custkey' AS check_id, 'data' AS category, CASE WHEN n > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
       CASE WHEN n > 0 THEN n || ' row(s) with o_custkey not found in customer.c_custkey'
            ELSE 'all o_custkey values resolve to customer.c_custkey' END AS detail, n
FROM ({FK_SQL})
""")
def dq_fk_orphans(spark, sf_dir):
    t = read(spark, sf_dir, "orders", "customer")
    return quality.check_foreign_key("orders", t["orders"], "o_custkey",
                                     t["customer"].where(star.IN_CREDIT_CUSTOMERS), "customer", "c_custkey")


RECOMPUTED = BuildSpec(
    TableSpec("analytics", "customer_names", (
        column("customer_id", "BIGINT", pk=True),
        column("full_name", "VARCHAR(200)"),
        column("nation_id", "INT"),
    )),
    ("customer",),
    (
        ColumnMapping("customer_id", DIRECT, "c_custkey"),
        ColumnMapping("full_name", UDF, ("c_name", "c_mktsegment"), udf="udf_full_name"),
        ColumnMapping("nation_id", DIRECT, "c_nationkey"),
    ))


@query("""
WITH target AS (
  SELECT c_custkey, CASE WHEN c_acctbal > 9500 THEN 'bad' WHEN c_acctbal > 9000 THEN NULL
                         ELSE trim(c_name || ' ' || c_mktsegment) END AS full_name, c_nationkey AS nation_id
  FROM customer WHERE c_acctbal >= 0),
counts AS (
  SELECT count(*) AS checked,
         count(*) FILTER (t.full_name IS DISTINCT FROM trim(c.c_name || ' ' || c.c_mktsegment)) AS names,
         count(*) FILTER (t.nation_id IS DISTINCT FROM c.c_nationkey) AS nations
  FROM target t JOIN customer c USING (c_custkey)),
rows AS (
  SELECT checked, unnest(['full_name', 'nation_id']) AS c, unnest(['udf_full_name', 'DIRECT']) AS f,
         unnest([names, nations]) AS n FROM counts)
SELECT 'D-udf-customer_names.' || c AS check_id, 'data' AS category,
       CASE WHEN n > 0 THEN 'FAIL' WHEN checked = 0 THEN 'WARN' ELSE 'PASS' END AS status,
       CASE WHEN checked = 0 THEN 'no rows to check'
            ELSE n || '/' || checked || ' row(s) mismatch re-invoking ' || f || '(...)' END AS detail, n
FROM rows
""")
def dq_recompute(spark, sf_dir):
    sources = read(spark, sf_dir, "customer")
    spoiled = F.when(F.col("c_acctbal") > 9500, "bad").when(F.col("c_acctbal") <= 9000, F.col("full_name"))
    target = (build(RECOMPUTED, sources).join(
        sources["customer"].select(F.col("c_custkey").alias("customer_id"), "c_acctbal"), "customer_id")
        .where(star.IN_CREDIT_CUSTOMERS).withColumn("full_name", spoiled).drop("c_acctbal"))
    return reconcile.check_recomputed(RECOMPUTED, star.CUSTOMER, target, sources, every_column=True)


DECLARED_ORDERS = TableSpec("raw", "orders", (
    column("O_ORDERKEY", "BIGINT", pk=True),
    column("o_custkey", "INT"),
    column("o_orderstatus", "VARCHAR(1)"),
    column("o_orderpriority", "VARCHAR(10)"),
    column("o_totalprice", "MONEY"),
    column("o_orderdate", "TIMESTAMP"),
    column("o_clerk", "TEXT"),
))


@query("""
WITH m AS (SELECT typeof(any_value(o_orderkey)) AS k, typeof(any_value(o_custkey)) AS c,
                  typeof(any_value(o_orderdate)) AS d, max(length(o_orderstatus)) AS s,
                  max(length(o_orderpriority)) AS p FROM orders),
r AS (SELECT unnest(['O_ORDERKEY', 'o_custkey', 'o_orderstatus', 'o_orderpriority', 'o_totalprice', 'o_orderdate', 'o_clerk']) AS c,
             unnest([CASE WHEN k <> 'BIGINT' THEN 'type mismatch' END,
                     CASE WHEN c <> 'INTEGER' THEN 'type mismatch: declared ''INT'', live ''' || lower(c) || '''' END,
                     CASE WHEN s > 1 THEN 'type mismatch' END,
                     CASE WHEN p > 10 THEN 'type mismatch: declared ''VARCHAR(10)'', live ''varchar(' || p || ')''' END,
                     NULL, CASE WHEN d <> 'TIMESTAMP' THEN 'type mismatch' END,
                     'column ''o_clerk'' missing from live table ''orders''']) AS problem FROM m)
SELECT 'S-source-orders.' || c AS check_id, 'schema' AS category,
       CASE WHEN problem IS NULL THEN 'PASS' ELSE 'FAIL' END AS status,
       coalesce(problem, 'matches live schema') AS detail,
       CAST(CASE WHEN problem IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n
FROM r
""")
def dq_schema(spark, sf_dir):
    return quality.check_schema(DECLARED_ORDERS, one(spark, sf_dir, "orders"), spark, "source")


@query("""
SELECT 'D-width-part.' || c AS check_id, 'data' AS category, CASE WHEN n > 0 THEN 'WARN' ELSE 'PASS' END AS status,
       CASE WHEN n > 0 THEN n || ' value(s) longer than ' || w || ', longest ' || longest
            ELSE 'longest value ' || longest || ' of ' || w END AS detail, n
FROM (SELECT unnest(['p_name', 'p_brand']) AS c, unnest([10, 10]) AS w,
             unnest([count(*) FILTER (length(p_name) > 10), count(*) FILTER (length(p_brand) > 10)]) AS n,
             unnest([max(length(p_name)), max(length(p_brand))]) AS longest FROM part)
""")
def dq_width(spark, sf_dir):
    return quality.check_width("part", one(spark, sf_dir, "part"), {"p_name": 10, "p_brand": 10})


@query("""
SELECT 'D-parse-events.event_date' AS check_id, 'data' AS category,
       CASE WHEN n > 0 THEN 'WARN' ELSE 'PASS' END AS status,
       CASE WHEN n > 0 THEN n || ' value(s) could not be parsed' ELSE 'all values parsed' END AS detail, n
FROM (SELECT count(*) FILTER (event_type = 'error') AS n FROM events)
""")
def dq_parsed(spark, sf_dir):
    raw = F.when(F.col("event_type") == "error", "bad").otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return quality.check_parsed("events", one(spark, sf_dir, "events"),
                                {"event_date": (raw, lib.parse_date(raw))})


@query(f"""
WITH a AS (SELECT c_custkey, md5(c_name || '|' || c_mktsegment) AS h FROM customer WHERE c_acctbal < 8000),
     b AS (SELECT c_custkey, md5(c_name || '|' || {SEGMENT_CHANGE_SQL}) AS h FROM customer WHERE c_acctbal >= 0)
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
       CASE WHEN b.h IS NULL THEN 'missing' WHEN a.h IS NULL THEN 'added' ELSE 'hash mismatch' END AS drift
FROM a FULL OUTER JOIN b ON a.c_custkey = b.c_custkey WHERE a.h IS DISTINCT FROM b.h
""")
def dq_drift(spark, sf_dir):
    first, second = customer_snapshots(spark, sf_dir)
    return quality.drift(first, second, ["c_custkey"], ["c_name", "c_mktsegment"])


@query("""
SELECT 'D-drift-customer' AS check_id, 'data' AS category, CASE WHEN m + a + c > 0 THEN 'WARN' ELSE 'PASS' END AS status,
       CASE WHEN m + a + c > 0 THEN m || ' missing, ' || a || ' added, ' || c || ' hash mismatch'
            ELSE 'no drift' END AS detail, m + a + c AS n
FROM (SELECT count(*) FILTER (c_acctbal < 0) AS m, count(*) FILTER (c_acctbal >= 8000) AS a,
             count(*) FILTER (c_acctbal >= 0 AND c_acctbal < 8000 AND c_mktsegment = 'BUILDING') AS c FROM customer)
""")
def dq_drift_check(spark, sf_dir):
    first, second = customer_snapshots(spark, sf_dir)
    return quality.check_drift("customer", first, second, ["c_custkey"], ["c_name", "c_mktsegment"])


def _report(spark, sf_dir):
    part = one(spark, sf_dir, "part")
    return quality.union_checks([
        dq_fk_orphans(spark, sf_dir), dq_pk_duplicates(spark, sf_dir), dq_not_null(spark, sf_dir),
        quality.check_unique("part", part, ["p_partkey"]), quality.check_width("part", part, {"p_name": 10}),
        quality.check_unique("customer", one(spark, sf_dir, "customer"), ["c_custkey"])])


REPORT_SQL = f"""
  SELECT 'orders' AS t, n > 0 AS bad, 3 AS rank FROM ({FK_SQL})
  UNION ALL SELECT 'lineitem', count(*) > 0, 3 FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 'orders', n > 0, 3 FROM ({NOT_NULL_SQL})
  UNION ALL SELECT 'part', count(*) > 0, 3 FROM (SELECT 1 FROM part GROUP BY p_partkey HAVING count(*) > 1)
  UNION ALL SELECT 'part', count(*) > 0, 2 FROM part WHERE length(p_name) > 10
  UNION ALL SELECT 'customer', count(*) > 0, 3 FROM (SELECT 1 FROM customer GROUP BY c_custkey HAVING count(*) > 1)
"""


@query(f"""
SELECT t AS "table", CASE max(CASE WHEN bad THEN rank ELSE 1 END) WHEN 3 THEN 'FAIL' WHEN 2 THEN 'WARN' ELSE 'PASS' END AS status,
       count(*) AS checks, count(*) FILTER (NOT bad) AS pass, count(*) FILTER (bad AND rank = 2) AS warn,
       count(*) FILTER (bad AND rank = 3) AS fail
FROM ({REPORT_SQL}) GROUP BY t
""")
def dq_report_rollup(spark, sf_dir):
    report = _report(spark, sf_dir).withColumn("table", quality.table_of_check(F.col("check_id")))
    return quality.roll_up(report, ["table"])


@query(f"""
SELECT 'data' AS category, CASE WHEN NOT bad THEN 'PASS' WHEN rank = 2 THEN 'WARN' ELSE 'FAIL' END AS status, count(*) AS checks
FROM ({REPORT_SQL}) GROUP BY 2
""")
def dq_report_summary(spark, sf_dir):
    return quality.summarise(_report(spark, sf_dir))


# --- run log ------------------------------------------------------------------------


def _event_log(spark, sf_dir):
    """Events read as a step log: one run per user, errors are failures."""
    failed = F.col("event_type") == "error"
    return one(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("seq"),
        F.col("event_type").alias("table"), F.lit(runlog.WRITE).alias("stage"), F.col("ts").alias("start_time"),
        F.when(failed, runlog.FAILURE).otherwise(runlog.SUCCESS).alias("status"),
        F.when(failed, F.col("props")).alias("error_message"))


@query("""
SELECT CAST(user_id AS VARCHAR) AS run_id, count(*) AS steps, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS tables,
       count(*) FILTER (event_type <> 'error') AS succeeded,
       count(*) FILTER (event_type = 'error') AS failed
FROM events GROUP BY user_id
""")
def run_summary(spark, sf_dir):
    return runlog.summarise_runs(_event_log(spark, sf_dir))


RUN_STATUS_SQL = """
SELECT CAST(user_id AS VARCHAR) AS run_id, CASE WHEN failed > 0 THEN 'FAIL' ELSE 'PASS' END AS status,
       CASE WHEN failed > 0 THEN 'error.write failed: ' || props ELSE steps || ' step(s) completed successfully' END AS detail,
       steps, failed
FROM (SELECT user_id, count(*) AS steps, count(*) FILTER (event_type = 'error') AS failed,
             arg_min(props, event_id) FILTER (event_type = 'error') AS props FROM events GROUP BY user_id)
"""


@query(RUN_STATUS_SQL)
def run_status(spark, sf_dir):
    return runlog.run_status(_event_log(spark, sf_dir))


@query(f"""
SELECT run_id, status, detail FROM ({RUN_STATUS_SQL})
WHERE run_id = (SELECT CAST(arg_max(user_id, event_id) AS VARCHAR) FROM events)
""")
def run_status_latest(spark, sf_dir):
    return runlog.latest_run_status(_event_log(spark, sf_dir))


@query("""
WITH s AS (SELECT CAST(o_custkey AS VARCHAR) AS run_id, min(o_orderdate) AS started, count(*) AS steps,
                  count(*) FILTER (o_orderstatus <> 'F') AS succeeded, count(*) FILTER (o_orderstatus = 'F') AS failed
           FROM orders GROUP BY o_custkey),
v AS (SELECT CAST(user_id AS VARCHAR) AS run_id,
             CASE WHEN bool_or(event_type = 'error') THEN 'FAIL' WHEN bool_or(event_type = 'view') THEN 'WARN' ELSE 'PASS' END AS validation,
             count(*) AS checks, count(*) FILTER (event_type NOT IN ('error', 'view')) AS pass,
             count(*) FILTER (event_type = 'view') AS warn, count(*) FILTER (event_type = 'error') AS fail
      FROM events GROUP BY user_id)
SELECT CAST(year(started) AS INTEGER) AS year, 'Q' || quarter(started) AS quarter, s.*, validation, checks, pass, warn, fail
FROM s LEFT JOIN v USING (run_id)
""")
def event_record_by_quarter(spark, sf_dir):
    """A status that is NULL counts as a step or check, and as no outcome of one."""
    t = read(spark, sf_dir, "orders", "events")
    state, kind = F.col("o_orderstatus"), F.col("event_type")
    log = t["orders"].select(
        F.col("o_custkey").cast("string").alias("run_id"), F.lit(runlog.WRITE).alias("stage"),
        F.col("o_orderdate").alias("start_time"),
        F.when(state == "F", runlog.FAILURE).when(state != "F", runlog.SUCCESS).alias("status"))
    report = t["events"].select(
        F.col("user_id").cast("string").alias("run_id"),
        F.when(kind == "error", quality.FAIL).when(kind == "view", quality.WARN)
        .when(kind.isNotNull(), quality.PASS).alias("status"))
    return runlog.event_record(log, report)


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, 'Q' || quarter(o_orderdate) AS quarter, count(*) AS steps,
       string_agg(DISTINCT o_orderpriority, ',' ORDER BY o_orderpriority) AS tables,
       count(*) FILTER (o_orderstatus <> 'F') AS succeeded, count(*) FILTER (o_orderstatus = 'F') AS failed
FROM orders GROUP BY ALL
""")
def run_summary_by_quarter(spark, sf_dir):
    log = one(spark, sf_dir, "orders").select(
        *runlog.year_and_quarter(F.col("o_orderdate")), F.col("o_orderpriority").alias("table"),
        F.when(F.col("o_orderstatus") == "F", runlog.FAILURE).otherwise(runlog.SUCCESS).alias("status"))
    return runlog.summarise_runs(log, ["year", "quarter"])
