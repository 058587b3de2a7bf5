"""The four raw tables, derived from star-schema sample tables.

The sample tables are a wholesale star schema (orders, lineitem, customer,
part, nation) and an event log; see README for the mapping. Each loader reads
only the files and columns its table needs. The mapping itself is plain SQL
expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.schemas import RAW
from basketry.session import pin_utc

_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, props STRING",
}

# Fixed values of the mapping.
_STATUS = """CASE WHEN o_orderkey % 20 = 0 THEN 'cancelled' WHEN o_orderkey % 20 = 1 THEN 'refunded'
    WHEN o_orderstatus = 'F' THEN 'delivered' WHEN o_orderstatus = 'P' THEN 'shipped'
    WHEN o_orderkey % 2 = 0 THEN 'confirmed' ELSE 'pending' END"""
_REGION = """CASE o_orderpriority WHEN '1-URGENT' THEN 'NA' WHEN '2-HIGH' THEN 'EU' WHEN '3-MEDIUM' THEN 'APAC'
    WHEN '4-NOT SPECIFIED' THEN 'LATAM' WHEN '5-LOW' THEN 'MEA' END"""
_PLAN = """CASE c_mktsegment WHEN 'BUILDING' THEN 'Enterprise' WHEN 'MACHINERY' THEN 'PRO'
    WHEN 'AUTOMOBILE' THEN 'starter' WHEN 'HOUSEHOLD' THEN 'free' WHEN 'FURNITURE' THEN 'trial' END"""
_SIGNUP = "date_add(DATE '1995-01-01', int(c_custkey * 37 % 1800))"
_COST_SHARE = "get(array(0.30D, 0.37D, 0.44D, 0.51D, 0.58D, 0.65D, 0.72D, 0.79D, 0.86D, 0.93D), p_size % 10)"
_EVENT_TYPE = """CASE event_type WHEN 'view' THEN 'ProductView' WHEN 'click' THEN 'AddToCart'
    WHEN 'signup' THEN 'CheckoutStart' WHEN 'purchase' THEN 'Purchase' WHEN 'error' THEN 'Search' END"""
_DEVICE = "get(array('mobile', 'tablet', 'desktop'), number % 3)"


def _load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    pin_utc(spark)
    return spark.read.schema(_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _stream(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    pin_utc(spark)
    # As a pattern, the table may be one file or a folder of files.
    return spark.readStream.schema(_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{{{table}.parquet}}")


def _orders(spark: SparkSession, orders: DataFrame, sf_dir: str) -> DataFrame:
    # One product per order: its lowest part key, all its units, its lowest
    # price and highest discount. Fixed-width aggregates, grouped by the join
    # key, which also lets Spark drop the join when no column of it is used.
    lines = _load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.min("l_partkey").alias("part"),
        F.sum("l_quantity").alias("units"),
        F.min("l_extendedprice").alias("price"),
        F.max("l_discount").alias("discount"),
    )
    return orders.join(lines, F.expr("o_orderkey = l_orderkey"), "left").selectExpr(
        "string(o_orderkey) AS order_id",
        "string(o_custkey) AS user_id",
        "string(part) AS product_id",
        f"{_STATUS} AS status",
        "int(units) AS quantity",
        "price AS unit_price",
        "rint(discount * 100) AS discount_amount",
        "o_orderdate AS created_at",
        f"{_REGION} AS region",
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _orders(spark, _load(spark, sf_dir, "orders"), sf_dir)


def stream_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order file as a stream; lines are a static side."""
    return _orders(spark, _stream(spark, sf_dir, "orders"), sf_dir)


def raw_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = _load(spark, sf_dir, "customer")
    # Provably unique keys: without use of the country the join is dropped.
    nation = _load(spark, sf_dir, "nation").dropDuplicates(["n_nationkey"])
    return customer.join(nation, F.expr("c_nationkey = n_nationkey"), "left").selectExpr(
        "string(c_custkey) AS user_id",
        "lower(c_name) || '@example.com' AS email",
        "c_name AS name",
        f"{_PLAN} AS plan_type",
        f"{_SIGNUP} AS signup_date",
        "n_name AS country",
        f"timestamp({_SIGNUP}) AS created_at",
        "string(c_acctbal >= 0) AS is_active",
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _load(spark, sf_dir, "part").selectExpr(
        "string(p_partkey) AS product_id",
        "p_name AS name",
        "p_type AS category",
        "p_brand AS subcategory",
        "p_retailprice AS base_price",
        f"p_retailprice * {_COST_SHARE} AS cost_price",
        "TIMESTAMP '1995-01-01 00:00:00' AS created_at",
        "'True' AS is_active",
    )


def _events(events: DataFrame) -> DataFrame:
    # At-least-once delivery: purchases arrive a second time, one second later.
    delivered = events.selectExpr(
        "*",
        "explode(CASE WHEN event_type = 'purchase' THEN array(0, 1) ELSE array(0) END) AS delay",
        "int(get_json_object(props, '$.k')) AS number",
        "string(user_id) || '-' || date_format(ts, 'yyyyMMdd') AS visitor",
    )
    return delivered.selectExpr(
        "string(event_id) AS event_id",
        "visitor AS user_id",
        "visitor AS session_id",
        f"{_EVENT_TYPE} AS event_type",
        "string(number) AS product_id",
        "'/' || event_type AS page",
        "string(NULL) AS referrer",
        f"{_DEVICE} AS device_type",
        "date_format(ts + make_dt_interval(0, 0, 0, delay), 'yyyy-MM-dd HH:mm:ss.SSSSSS') AS created_at",
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(_load(spark, sf_dir, "events"))


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(_stream(spark, sf_dir, "events"))


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    loaders = {"orders": raw_orders, "users": raw_users, "products": raw_products, "events": raw_events}
    return {table: loaders[table](spark, sf_dir) for table in RAW}
