"""Star schema: four dimensions and two facts from Silver."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions import date_key, surrogate_key
from shopledger.operators import SkewPolicy, hot_keys, skew_join
from shopledger.plans.silver import Silver
from shopledger.schemas import AMOUNT_TOLERANCE

DIMENSIONS = ("dim_customer", "dim_product", "dim_date", "dim_channel")
FACTS = ("fact_sales", "fact_campaign_events")

Warehouse = Mapping[str, DataFrame]


class WarehouseLoadError(RuntimeError):
    """The loaded facts contradict Silver."""


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "email_hash",
        "phone_masked",
        "customer_city",
        "customer_segment",
        "created_at",
        "updated_at",
    )


def dim_product(products: DataFrame) -> DataFrame:
    return products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        "product_name",
        "category",
        F.col("unit_price").alias("current_unit_price"),
        "is_active",
        "created_at",
        "updated_at",
    )


def calendar_attributes(days: DataFrame) -> DataFrame:
    """Calendar columns of a ``calendar_date``; Sunday is day 0 of the week."""
    day = F.col("calendar_date")
    return days.select(
        date_key(day).alias("date_key"),
        "calendar_date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        (F.dayofweek(day) - 1).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.dayofweek(day).isin(1, 7).alias("is_weekend"),
    )


def dim_date(orders: DataFrame, events: DataFrame) -> DataFrame:
    """One row per day on which an order or an event happened."""
    order_days = orders.select(F.to_date("order_timestamp").alias("calendar_date"))
    event_days = events.select(F.to_date("event_timestamp").alias("calendar_date"))
    return calendar_attributes(order_days.union(event_days).distinct())


def dim_channel(events: DataFrame) -> DataFrame:
    return (
        events.select("channel")
        .distinct()
        .select(surrogate_key("channel").alias("channel_key"), "channel")
    )


def _with_parent(
    df: DataFrame,
    parent: DataFrame,
    business_key: str,
    row_id: str,
    *,
    policy: SkewPolicy,
    verified: bool,
) -> DataFrame:
    """The rows whose parent is known; verified data, whose parents are all known, needs
    no join for that. The dimension's surrogate key is a function of the business key
    and is derived after the last join: digests do not compress in a shuffle."""
    if verified:
        return df
    return skew_join(
        df,
        parent.select(business_key),
        business_key,
        left_hot=hot_keys(df, business_key, policy),
        left_id=row_id,
    )


def fact_sales(
    silver: Silver, policy: SkewPolicy = SkewPolicy(), *, verified: bool = False
) -> DataFrame:
    """One row per order item with its order, payment and dimension keys.

    All joins are inner. The customer join runs at order grain, before the
    larger item side takes part. The date dimension holds every order date, so
    joining it would only drop null dates; the key is derived in place instead.

    ``verified`` says that this Silver passed the gate: keys are unique, and no
    row has a null or unknown customer or product. Then the customer and product
    joins would keep every row once, and the items are shuffled on their order
    alone.
    """
    orders = silver["orders"].where(F.col("order_timestamp").isNotNull()).select(
        "order_id",
        "customer_id",
        "order_status",
        "order_timestamp",
        date_key(F.to_date("order_timestamp")).alias("date_key"),
    )
    orders = _with_parent(
        orders,
        silver["customers"],
        "customer_id",
        "order_id",
        policy=policy,
        verified=verified,
    )
    payments = silver["payments"].select(
        "order_id", "payment_id", "payment_method", "payment_timestamp"
    )
    payment_orders = hot_keys(payments, "order_id", policy)
    paid_orders = skew_join(
        payments, orders, "order_id", left_hot=payment_orders, left_id="payment_id"
    )
    items = _with_parent(
        silver["order_items"].drop("updated_at"),
        silver["products"],
        "product_id",
        "order_item_id",
        policy=policy,
        verified=verified,
    )
    return skew_join(
        items,
        paid_orders,
        "order_id",
        left_hot=hot_keys(silver["order_items"], "order_id", policy),
        left_id="order_item_id",
        right_hot=payment_orders,
        right_id="payment_id",
    ).select(
        F.col("order_item_id").alias("sales_key"),
        "order_item_id",
        "order_id",
        surrogate_key("customer_id").alias("customer_key"),
        surrogate_key("product_id").alias("product_key"),
        "date_key",
        "order_status",
        "payment_method",
        "quantity",
        "unit_price",
        F.col("line_amount").alias("gross_amount"),
        "order_timestamp",
        "payment_timestamp",
    )


def fact_campaign_events(
    silver: Silver, policy: SkewPolicy = SkewPolicy(), *, verified: bool = False
) -> DataFrame:
    """One row per event of a known customer. Channel and date keys are derived
    in place: both dimensions are made from these same events."""
    events = silver["campaign_events"].where(
        F.col("channel").isNotNull() & F.col("event_timestamp").isNotNull()
    )
    return _with_parent(
        events,
        silver["customers"],
        "customer_id",
        "event_id",
        policy=policy,
        verified=verified,
    ).select(
        F.col("event_id").alias("campaign_event_key"),
        "event_id",
        "campaign_id",
        surrogate_key("customer_id").alias("customer_key"),
        surrogate_key("channel").alias("channel_key"),
        date_key(F.to_date("event_timestamp")).alias("date_key"),
        "event_type",
        "revenue",
        "event_timestamp",
    )


def affected_orders(changed: Mapping[str, DataFrame]) -> DataFrame:
    """Ids of the orders whose sales facts may differ after changes (was, now) of
    orders, items and payments: an item or payment that moved affects both its orders."""
    ids = [
        rows.select(F.col(f"{side}.order_id").alias("order_id"))
        for name in ("orders", "order_items", "payments")
        for rows in [changed[name]]
        for side in ("was", "now")
    ]
    return reduce(DataFrame.union, ids).where(F.col("order_id").isNotNull()).distinct()


def affected_days(orders: DataFrame, affected: DataFrame, changed_orders: DataFrame) -> DataFrame:
    """Date keys on which affected orders lie now, or lay before."""
    now = orders.join(affected, "order_id", "left_semi").select("order_timestamp")
    was = changed_orders.select(F.col("was.order_timestamp").alias("order_timestamp"))
    days = now.union(was).select(date_key(F.to_date("order_timestamp")).alias("date_key"))
    return days.where(F.col("date_key").isNotNull()).distinct()


def sales_of_orders(silver: Silver, affected: DataFrame) -> DataFrame:
    """The sales facts of some orders of verified Silver. Orders, items and payments
    are cut down by their order's id before they meet."""
    some = {
        name: silver[name].join(affected, "order_id", "left_semi")
        for name in ("orders", "order_items", "payments")
    }
    return fact_sales({**silver, **some}, verified=True)


def build_dimensions(silver: Silver) -> dict[str, DataFrame]:
    return {
        "dim_customer": dim_customer(silver["customers"]),
        "dim_product": dim_product(silver["products"]),
        "dim_date": dim_date(silver["orders"], silver["campaign_events"]),
        "dim_channel": dim_channel(silver["campaign_events"]),
    }


def build_warehouse(
    silver: Silver, policy: SkewPolicy = SkewPolicy(), *, verified: bool = False
) -> dict[str, DataFrame]:
    return {
        **build_dimensions(silver),
        "fact_sales": fact_sales(silver, policy, verified=verified),
        "fact_campaign_events": fact_campaign_events(silver, policy, verified=verified),
    }


def load_assertions(silver: Silver, warehouse: Warehouse) -> DataFrame:
    """One row with the numbers a load is judged by, and the judgement.

    Sales keys must be unique and fact revenue must equal Silver revenue to the
    cent, all statuses included. Surrogate-key collisions are counted too: a
    hash that merged two business keys would fan the marts out. Distinct keys are
    counted apart from the sums, so that their shuffle carries the key alone.
    """
    sales = warehouse["fact_sales"].agg(
        F.count(F.lit(1)).alias("fact_sales_rows"),
        F.coalesce(F.sum("gross_amount"), F.lit(0)).alias("warehouse_revenue"),
    )
    keys = warehouse["fact_sales"].agg(F.count_distinct("sales_key"))
    events = warehouse["fact_campaign_events"].agg(F.count(F.lit(1)))
    revenue = silver["order_items"].agg(F.coalesce(F.sum("line_amount"), F.lit(0)))

    def collisions(dim: str, key: str) -> Column:
        distinct = warehouse[dim].agg(F.count_distinct(key))
        return warehouse[dim].agg(F.count(F.lit(1))).scalar() - distinct.scalar()

    metrics = sales.select(
        "fact_sales_rows",
        keys.scalar().alias("distinct_sales_keys"),
        events.scalar().alias("fact_campaign_rows"),
        revenue.scalar().alias("silver_revenue"),
        "warehouse_revenue",
        (
            collisions("dim_customer", "customer_key")
            + collisions("dim_product", "product_key")
        ).alias("key_collisions"),
    )
    difference = F.abs(F.col("silver_revenue") - F.col("warehouse_revenue"))
    return metrics.withColumns(
        {
            "sales_keys_unique": F.col("fact_sales_rows") == F.col("distinct_sales_keys"),
            "revenue_reconciles": difference <= F.lit(AMOUNT_TOLERANCE).cast("decimal(12,2)"),
        }
    )


def require_loaded(metrics: dict) -> None:
    """Raise on the driver from the one row of ``load_assertions``."""
    if not metrics["sales_keys_unique"]:
        raise WarehouseLoadError("Loaded sales facts have duplicate keys.")
    if not metrics["revenue_reconciles"]:
        raise WarehouseLoadError(
            f"Revenue does not reconcile: {metrics['warehouse_revenue']} in the facts, "
            f"{metrics['silver_revenue']} in Silver."
        )
    if metrics["key_collisions"]:
        raise WarehouseLoadError(f"{metrics['key_collisions']} surrogate keys collide.")
