"""The six sources in their source shape, from TPC-H-like sample tables.

Ids are zero-padded to nine digits. Text columns are left untidy on purpose
(blanks, upper case) and order items repeat, so that Silver has work to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.operators import latest_by_key
from shopledger.schemas import SOURCES

# Columns used here, in DDL; reading with a schema saves a pass over footers.
_COLUMNS = {
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_mktsegment STRING",
    "nation": "n_nationkey INT, n_name STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
    "value DOUBLE, props STRING",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def _id(prefix: str, key: str) -> str:
    return f"concat('{prefix}', lpad(cast({key} AS string), 9, '0'))"


def customers(spark: SparkSession, folder: str) -> DataFrame:
    since = "timestamp '1995-01-01 00:00:00' + make_interval(0, 0, 0, 0, cast(c_custkey AS int))"
    return (
        _table(spark, folder, "customer")
        .join(_table(spark, folder, "nation"), F.expr("c_nationkey = n_nationkey"))
        .selectExpr(
            f"{_id('CUST', 'c_custkey')} AS customer_id",
            "c_name AS full_name",
            "concat(lower(c_name), '@example.com') AS email",
            "concat('+66-02-555-', lpad(cast(c_custkey % 10000 AS string), 4, '0')) AS phone",
            "concat(cast(c_custkey AS string), ' Demo Road') AS address",
            "n_name AS city",
            "lower(c_mktsegment) AS customer_segment",
            f"{since} AS created_at",
            f"{since} AS updated_at",
        )
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").selectExpr(
        f"{_id('PROD', 'p_partkey')} AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "cast(p_retailprice AS decimal(12,2)) AS unit_price",
        "p_size % 13 <> 0 AS is_active",
        "timestamp '1995-01-01 00:00:00' AS created_at",
        "timestamp '1995-01-01 00:00:00' AS updated_at",
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    hours = "make_interval(0, 0, 0, 0, cast(o_orderkey % 24 + 1 AS int))"
    return _table(spark, folder, "orders").selectExpr(
        f"{_id('ORD', 'o_orderkey')} AS order_id",
        f"{_id('CUST', 'o_custkey')} AS customer_id",
        "CASE o_orderstatus WHEN 'F' THEN ' COMPLETED' WHEN 'O' THEN 'Shipped ' "
        "ELSE 'cancelled' END AS order_status",
        "cast(o_orderdate AS timestamp) AS order_timestamp",
        f"cast(o_orderdate AS timestamp) + {hours} AS updated_at",
    )


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "lineitem").selectExpr(
        f"concat({_id('ITEM', 'l_orderkey')}, '-', cast(l_linenumber AS string)) AS order_item_id",
        f"{_id('ORD', 'l_orderkey')} AS order_id",
        f"{_id('PROD', 'l_partkey')} AS product_id",
        "cast(l_quantity AS int) AS quantity",
        "cast(l_extendedprice AS decimal(12,2)) AS unit_price",
        "cast(l_shipdate AS timestamp) AS updated_at",
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """One payment per order over the total of its current items, or over the
    order's own total where it has none."""
    items = latest_by_key(order_items(spark, folder), ["order_item_id"], ["updated_at"])
    totals = items.groupBy("order_id").agg(
        F.expr("sum(cast(quantity * unit_price AS decimal(12,2)))").alias("item_total")
    )
    minutes = "make_interval(0, 0, 0, 0, 0, cast(o_orderkey % 90 + 1 AS int))"
    return (
        _table(spark, folder, "orders")
        .selectExpr("*", f"{_id('ORD', 'o_orderkey')} AS order_id")
        .join(totals, "order_id", "left")
        .selectExpr(
            "concat('PAY', substring(order_id, 4)) AS payment_id",
            "order_id",
            "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'Card' WHEN '2' THEN ' promptpay' "
            "WHEN '3' THEN 'BANK_TRANSFER' ELSE 'wallet' END AS payment_method",
            "cast(coalesce(item_total, cast(o_totalprice AS decimal(12,2))) AS decimal(12,2)) "
            "AS payment_amount",
            f"cast(o_orderdate AS timestamp) + {minutes} AS payment_timestamp",
            f"cast(o_orderdate AS timestamp) + {minutes} AS updated_at",
        )
    )


def campaign_events(
    spark: SparkSession, folder: str, *, raw_types: bool = False
) -> DataFrame:
    """All events as campaign events: a purchase is a conversion, any other a click.
    With ``raw_types`` the other types keep their names, for the checks."""
    other = "event_type" if raw_types else "'click'"
    return _table(spark, folder, "events").selectExpr(
        f"{_id('EVT', 'event_id')} AS event_id",
        "concat('camp-', cast(cast(get_json_object(props, '$.k') AS int) % 10 AS string)) "
        "AS campaign_id",
        "CASE event_id % 4 WHEN 0 THEN ' Email ' WHEN 1 THEN 'SOCIAL' WHEN 2 THEN 'search' "
        "ELSE 'Affiliate' END AS channel",
        f"{_id('CUST', 'user_id')} AS customer_id",
        f"CASE WHEN event_type = 'purchase' THEN 'Conversion' ELSE {other} END AS event_type",
        "value AS revenue",
        "cast(ts AS timestamp) AS event_timestamp",
        "cast(ts AS timestamp) + INTERVAL 5 MINUTES AS updated_at",
    )


_READERS = {
    "customers": customers,
    "products": products,
    "orders": orders,
    "order_items": order_items,
    "payments": payments,
    "campaign_events": campaign_events,
}


def sample_tables(spark: SparkSession, folder: str) -> list[DataFrame]:
    """The tables that the sources are made from."""
    return [_table(spark, folder, name) for name in _COLUMNS]


def sample_source(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _READERS[name](spark, folder)


def sample_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: sample_source(spark, folder, name) for name in SOURCES}
