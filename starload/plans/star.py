"""Table and build specs of the star schema over the test tables.

customer, part and supplier become dimensions, orders and lineitem facts.
"""

from __future__ import annotations

import datetime

from starload.sources.warehouse import ANALYTICS, RAW
from starload.spec import (
    CONSTANT, DEFAULT, DIRECT, EXPRESSION, GENERATED, LOOKUP, RUN_TIMESTAMP, SEQUENCE, UDF, UUID,
    BuildSpec, Call, ColumnMapping, Join, Lookup, TableSpec, column,
)

RUN_TS = datetime.datetime(2026, 1, 1, 0, 0, 0)
AS_OF = datetime.date(1998, 6, 15)

CUSTOMER = TableSpec(RAW, "customer", (
    column("c_custkey", "BIGINT", pk=True),
    column("c_name", "TEXT"),
    column("c_nationkey", "INT", fk=("nation", "n_nationkey")),
    column("c_acctbal", "DOUBLE"),
    column("c_mktsegment", "VARCHAR(10)"),
))
SUPPLIER = TableSpec(RAW, "supplier", (
    column("s_suppkey", "BIGINT", pk=True),
    column("s_name", "TEXT"),
    column("s_nationkey", "INT", fk=("nation", "n_nationkey")),
    column("s_acctbal", "DOUBLE"),
))
PART = TableSpec(RAW, "part", (
    column("p_partkey", "BIGINT", pk=True),
    column("p_name", "TEXT"),
    column("p_brand", "TEXT"),
    column("p_type", "TEXT"),
    column("p_size", "INT"),
    column("p_retailprice", "DOUBLE"),
))
ORDERS = TableSpec(RAW, "orders", (
    column("o_orderkey", "BIGINT", pk=True),
    column("o_custkey", "BIGINT", fk=("customer", "c_custkey")),
    column("o_orderstatus", "VARCHAR(1)"),
    column("o_totalprice", "DOUBLE"),
    column("o_orderdate", "TIMESTAMP"),
    column("o_orderpriority", "VARCHAR(15)"),
))
EVENTS = TableSpec(RAW, "events", (
    column("event_id", "BIGINT", pk=True),
    column("ts", "TIMESTAMP"),
    column("user_id", "BIGINT", fk=("customer", "c_custkey")),
    column("event_type", "TEXT"),
    column("value", "DOUBLE"),
    column("props", "TEXT"),
))
RAW_TABLES = {t.name: t for t in (CUSTOMER, SUPPLIER, PART, ORDERS, EVENTS)}

# Customers and suppliers in debt are kept out of the dimensions below, so that
# facts exist whose lookup misses.
IN_CREDIT_CUSTOMERS = "c_acctbal >= 0"
IN_CREDIT_SUPPLIERS = "s_acctbal >= 0"


def direct(target: str, source: str, table: str | None = None) -> ColumnMapping:
    return ColumnMapping(target, DIRECT, source, table)


def row_number(target: str, *order_by: str) -> ColumnMapping:
    return ColumnMapping(target, GENERATED, order_by=order_by)


DIM_CUSTOMER = TableSpec(ANALYTICS, "dim_customer", (
    column("customer_key", "BIGINT", pk=True),
    column("customer_id", "BIGINT", nullable=False),
    column("full_name", "VARCHAR(200)"),
    column("nation_id", "INT"),
    column("source_system", "VARCHAR(10)", nullable=False),
))
_DIM_CUSTOMER_COLUMNS = (
    row_number("customer_key", "c_custkey"),
    direct("customer_id", "c_custkey"),
    ColumnMapping("full_name", UDF, ("c_name", "c_mktsegment"), udf="udf_full_name"),
    direct("nation_id", "c_nationkey"),
    ColumnMapping("source_system", CONSTANT, value="TPCH"),
)
BUILD_DIM_CUSTOMER = BuildSpec(DIM_CUSTOMER, ("customer",), _DIM_CUSTOMER_COLUMNS, grain=("customer_id",))
BUILD_DIM_CUSTOMER_IN_CREDIT = BuildSpec(
    DIM_CUSTOMER, ("customer",), _DIM_CUSTOMER_COLUMNS, filters=(IN_CREDIT_CUSTOMERS,))

BUILD_DIM_PART = BuildSpec(
    TableSpec(ANALYTICS, "dim_part", (
        column("part_key", "BIGINT", pk=True),
        column("part_id", "BIGINT", nullable=False),
        column("part_name", "VARCHAR(55)"),
    )),
    ("part",),
    (row_number("part_key", "p_partkey"), direct("part_id", "p_partkey"), direct("part_name", "p_name")))

BUILD_DIM_SUPPLIER_IN_CREDIT = BuildSpec(
    TableSpec(ANALYTICS, "dim_supplier", (
        column("supplier_key", "BIGINT", pk=True),
        column("supplier_id", "BIGINT", nullable=False),
    )),
    ("supplier",),
    (row_number("supplier_key", "s_suppkey"), direct("supplier_id", "s_suppkey")),
    filters=(IN_CREDIT_SUPPLIERS,))

BUILD_FACT_ORDER = BuildSpec(
    TableSpec(ANALYTICS, "fact_order", (
        column("order_key", "BIGINT", pk=True),
        column("order_id", "BIGINT", nullable=False),
        column("customer_key", "BIGINT", fk=("dim_customer", "customer_key"), nullable=False),
        column("status", "VARCHAR(10)"),
        column("total_price", "NUMERIC(12,2)"),
        column("order_date", "DATE"),
    )),
    ("orders",),
    (
        row_number("order_key", "o_orderkey"),
        direct("order_id", "o_orderkey"),
        ColumnMapping("customer_key", LOOKUP, lookup=Lookup(
            "dim_customer", "customer_key", (("o_custkey", "customer_id"),))),
        direct("status", "o_orderstatus"),
        direct("total_price", "o_totalprice"),
        direct("order_date", "o_orderdate"),
    ),
    grain=("order_id",))

BUILD_FACT_LINEITEM = BuildSpec(
    TableSpec(ANALYTICS, "fact_lineitem", (
        column("order_id", "BIGINT", nullable=False),
        column("line_number", "INT", nullable=False),
        column("part_key", "BIGINT", fk=("dim_part", "part_key")),
        column("supplier_key", "BIGINT", fk=("dim_supplier", "supplier_key")),
        column("quantity", "NUMERIC(12,2)"),
        column("ship_date", "DATE"),
    )),
    ("lineitem",),
    (
        direct("order_id", "l_orderkey"),
        direct("line_number", "l_linenumber"),
        ColumnMapping("part_key", LOOKUP, lookup=Lookup("dim_part", "part_key", (("l_partkey", "part_id"),))),
        ColumnMapping("supplier_key", LOOKUP, lookup=Lookup(
            "dim_supplier", "supplier_key", (("l_suppkey", "supplier_id"),), unknown_key=-1)),
        direct("quantity", "l_quantity"),
        direct("ship_date", "l_shipdate"),
    ))

BUILD_FINISHED_ORDERS = BuildSpec(
    TableSpec(ANALYTICS, "finished_orders", (
        column("order_id", "BIGINT", pk=True),
        column("status", "VARCHAR(1)"),
        column("order_date", "DATE"),
    )),
    ("orders",),
    (direct("order_id", "o_orderkey"), direct("status", "o_orderstatus"), direct("order_date", "o_orderdate")),
    filters=("o_orderstatus = 'F'",))

BUILD_REVENUE = BuildSpec(
    TableSpec(ANALYTICS, "revenue", (
        column("order_id", "BIGINT"),
        column("line_number", "INT"),
        column("revenue", "NUMERIC(18,2)"),
    )),
    ("lineitem",),
    (
        direct("order_id", "l_orderkey"),
        direct("line_number", "l_linenumber"),
        ColumnMapping("revenue", EXPRESSION, expression=(
            "cast(lineitem.l_extendedprice AS decimal(12,2)) * (1 - cast(lineitem.l_discount AS decimal(4,2)))")),
    ))

BUILD_ORDER_STATUS = BuildSpec(
    TableSpec(ANALYTICS, "order_status", (
        column("order_id", "BIGINT", pk=True),
        column("status", "VARCHAR(10)", nullable=False),
        column("channel", "VARCHAR(10)", nullable=False),
    )),
    ("orders",),
    (
        direct("order_id", "o_orderkey"),
        ColumnMapping("status", DEFAULT, "known_status", value="UNKNOWN"),
        ColumnMapping("channel", DEFAULT, value="BATCH"),
    ))

BUILD_NEW_CUSTOMERS = BuildSpec(
    TableSpec(ANALYTICS, "customer_numbers", (
        column("customer_key", "BIGINT", pk=True),
        column("customer_id", "BIGINT", nullable=False),
    )),
    ("customer",),
    (ColumnMapping("customer_key", SEQUENCE, order_by=("c_custkey",)), direct("customer_id", "c_custkey")),
    filters=("c_mktsegment <> 'BUILDING'",))

BUILD_CUSTOMER_UUID = BuildSpec(
    TableSpec(ANALYTICS, "customer_uuid", (
        column("customer_uuid", "UUID", pk=True),
        column("customer_id", "BIGINT", nullable=False),
    )),
    ("customer",),
    (ColumnMapping("customer_uuid", UUID, "c_custkey"), direct("customer_id", "c_custkey")))

BUILD_CUSTOMER_GEOGRAPHY = BuildSpec(
    TableSpec(ANALYTICS, "customer_geography", (
        column("customer_id", "BIGINT", pk=True),
        column("nation", "VARCHAR(25)"),
        column("region", "VARCHAR(25)"),
    )),
    ("customer", "nation", "region"),
    (
        direct("customer_id", "c_custkey"),
        direct("nation", "n_name", "nation"),
        direct("region", "r_name", "region"),
    ),
    joins=(
        Join("nation", "customer.c_nationkey = nation.n_nationkey", "left"),
        Join("region", "nation.n_regionkey = region.r_regionkey", "left"),
    ))

BUILD_PART_TYPED = BuildSpec(
    TableSpec(ANALYTICS, "part_typed", (
        column("part_id", "BIGINT", pk=True),
        column("brand_number", "INT"),
        column("type_number", "INT"),
        column("size", "SMALLINT"),
        column("retail_price", "DECIMAL(10,2)"),
    )),
    ("part",),
    (
        direct("part_id", "p_partkey"),
        ColumnMapping("brand_number", EXPRESSION, expression="substring(p_brand, 7)"),
        ColumnMapping("type_number", DIRECT, "p_type", try_cast=True),
        direct("size", "p_size"),
        direct("retail_price", "p_retailprice"),
    ))

BUILD_CUSTOMER_VERSION_KEY = BuildSpec(
    TableSpec(ANALYTICS, "customer_version_key", (
        column("customer_bk", "VARCHAR(20)", pk=True),
        column("customer_dk", "VARCHAR(32)", nullable=False),
        column("customer_dk_sql", "VARCHAR(32)", nullable=False),
        column("_loaded_at", "TIMESTAMP", nullable=False),
    )),
    ("customer",),
    (
        ColumnMapping("customer_bk", UDF, "c_custkey", udf="udf_calculate_patient_bk"),
        ColumnMapping("customer_dk", UDF, udf=Call("udf_generate_dk", (
            Call("udf_calculate_patient_bk", ("c_custkey",)), RUN_TIMESTAMP))),
        ColumnMapping("customer_dk_sql", EXPRESSION, expression=(
            "udf_generate_dk(udf_calculate_patient_bk(cast(c_custkey AS string)),"
            f" timestamp_ntz'{RUN_TS.isoformat(' ')}')")),
        ColumnMapping("_loaded_at", CONSTANT, value=RUN_TIMESTAMP),
    ))
