"""Serving views over the star schema. Cancelled orders are left out.

Sales facts are first reduced to one row per order. An order has one date and
one customer (Silver orders are unique, and a load that breaks this fails its
sales-key assertion), so counting orders afterwards is a plain count, and each
dimension joins rows that are already grouped by its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions import percent, ratio
from shopledger.operators import SkewPolicy, hot_keys, skew_join
from shopledger.plans.warehouse import Warehouse

MART_NAMES = (
    "vw_executive_summary",
    "vw_daily_sales",
    "vw_product_performance",
    "vw_customer_segments",
    "vw_campaign_performance",
)


def _kept(sales: DataFrame) -> DataFrame:
    # A null status is dropped as well.
    return sales.where(F.col("order_status") != "cancelled")


def sales_by_order(sales: DataFrame) -> DataFrame:
    """Revenue and units of each order that counts."""
    return (
        _kept(sales)
        .groupBy("order_id", "customer_key", "date_key")
        .agg(F.sum("gross_amount").alias("revenue"), F.sum("quantity").alias("units"))
    )


def _revenue():
    return F.round(F.sum("revenue"), 2).alias("revenue")


def executive_summary(sales: DataFrame) -> DataFrame:
    return (
        sales_by_order(sales)
        .agg(
            F.sum("revenue").alias("revenue"),
            F.count(F.lit(1)).alias("orders"),
            F.sum("units").alias("units"),
        )
        .select(
            F.round("revenue", 2).alias("revenue"),
            "orders",
            ratio(F.col("revenue"), F.col("orders")).alias("average_order_value"),
            "units",
        )
    )


def day_totals(sales: DataFrame) -> DataFrame:
    """Revenue, orders and units of each day, by its key."""
    return (
        sales_by_order(sales)
        .groupBy("date_key")
        .agg(
            F.sum("revenue").alias("revenue"),
            F.count(F.lit(1)).alias("orders"),
            F.sum("units").alias("units"),
        )
    )


def daily_sales(sales: DataFrame, dates: DataFrame) -> DataFrame:
    """One row per day with sales, in date order."""
    return daily_view(day_totals(sales), dates)


def daily_view(days: DataFrame, dates: DataFrame) -> DataFrame:
    return (
        days.join(dates.select("date_key", "calendar_date"), "date_key")
        .select(
            "calendar_date",
            F.round("revenue", 2).alias("revenue"),
            "orders",
            ratio(F.col("revenue"), F.col("orders")).alias("average_order_value"),
            "units",
        )
        .orderBy("calendar_date")
    )


def product_performance(
    sales: DataFrame, products: DataFrame, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """Revenue, units and orders by category and product name. Several products
    may share a name, so orders are counted distinct after the join, on rows
    reduced to one per product and order before it."""
    lines = (
        _kept(sales)
        .groupBy("order_id", "product_key")
        .agg(F.sum("gross_amount").alias("revenue"), F.sum("quantity").alias("units"))
    )
    named = skew_join(
        lines,
        products.select("product_key", "category", "product_name"),
        "product_key",
        left_hot=hot_keys(sales, "product_key", policy),
        left_id="order_id",
    )
    return named.groupBy("category", "product_name").agg(
        _revenue(),
        F.sum("units").alias("units"),
        F.count_distinct("order_id").alias("orders"),
    )


def customer_totals(sales: DataFrame) -> DataFrame:
    """Revenue and orders of each customer, by its key."""
    return (
        sales_by_order(sales)
        .groupBy("customer_key")
        .agg(F.sum("revenue").alias("revenue"), F.count(F.lit(1)).alias("orders"))
    )


def customer_segments(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Customers, orders and revenue by segment. Sales are reduced to one row
    per customer before the join, so a customer with a large share of all orders
    is one row there, and both distinct counts become sums."""
    return segment_view(customer_totals(sales), customers)


def segment_view(totals: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        totals.join(customers.select("customer_key", "customer_segment"), "customer_key")
        .groupBy("customer_segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("orders").alias("orders"),
            _revenue(),
        )
    )


def campaign_totals(events: DataFrame) -> DataFrame:
    """Events, clicks, conversions and revenue by campaign and channel key."""
    return events.groupBy("campaign_id", "channel_key").agg(
        F.count_if(F.col("event_type") == "click").alias("clicks"),
        F.count_if(F.col("event_type") == "conversion").alias("conversions"),
        F.sum("revenue").alias("revenue"),
        F.count(F.lit(1)).alias("events"),
    )


def campaign_performance(events: DataFrame, channels: DataFrame) -> DataFrame:
    """Clicks, conversions, revenue and conversion rate by campaign and channel."""
    return campaign_view(campaign_totals(events), channels)


def campaign_view(totals: DataFrame, channels: DataFrame) -> DataFrame:
    return totals.join(channels, "channel_key").select(
        "campaign_id",
        "channel",
        "clicks",
        "conversions",
        F.round("revenue", 2).alias("attributed_revenue"),
        percent(F.col("conversions"), F.col("events")).alias("conversion_rate_percent"),
    )


def build_marts(warehouse: Warehouse, policy: SkewPolicy = SkewPolicy()) -> dict[str, DataFrame]:
    sales = warehouse["fact_sales"]
    return {
        "vw_executive_summary": executive_summary(sales),
        "vw_daily_sales": daily_sales(sales, warehouse["dim_date"]),
        "vw_product_performance": product_performance(sales, warehouse["dim_product"], policy),
        "vw_customer_segments": customer_segments(sales, warehouse["dim_customer"]),
        "vw_campaign_performance": campaign_performance(
            warehouse["fact_campaign_events"], warehouse["dim_channel"]
        ),
    }


def executive_from_daily(daily: DataFrame) -> DataFrame:
    """The grand total again, from the daily view. Sums add up because an order
    has one date; the ratio is taken anew."""
    return daily.agg(
        F.round(F.sum("revenue"), 2).alias("revenue"),
        F.sum("orders").alias("orders"),
        F.sum("units").alias("units"),
    ).select(
        "revenue",
        "orders",
        ratio(F.col("revenue"), F.col("orders")).alias("average_order_value"),
        "units",
    )


def daily_coverage(daily: DataFrame) -> DataFrame:
    return daily.agg(
        F.count(F.lit(1)).alias("daily_points"),
        F.min("calendar_date").alias("start_date"),
        F.max("calendar_date").alias("end_date"),
        F.round(F.sum("revenue"), 2).alias("revenue"),
        F.sum("orders").alias("orders"),
        F.sum("units").alias("units"),
    )


def first_days(daily: DataFrame, days: int = 5) -> DataFrame:
    return daily.orderBy("calendar_date").limit(days)


def register_views(warehouse: Warehouse, policy: SkewPolicy = SkewPolicy()) -> None:
    """Make tables and serving views available to ``spark.sql``."""
    for name, df in {**warehouse, **build_marts(warehouse, policy)}.items():
        df.createOrReplaceTempView(name)
