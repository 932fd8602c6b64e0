"""Faults for the quality checks, put into Silver by value."""

from __future__ import annotations

from pyspark.sql import functions as F

from shopledger.plans.silver import Silver


def faulty_silver(silver: Silver) -> Silver:
    """Silver with faults for every row rule, key rule and relationship."""
    customers = silver["customers"].where(F.col("customer_segment") != "machinery")
    products = silver["products"].withColumn(
        "unit_price", F.when(F.col("is_active"), F.col("unit_price")).otherwise(-F.col("unit_price"))
    )
    orders = silver["orders"].withColumns(
        {
            "order_status": F.when(
                F.col("order_timestamp") < F.lit("1996-01-01").cast("timestamp"), "returned"
            ).otherwise(F.col("order_status")),
            "customer_id": F.when(F.hour("updated_at") != 7, F.col("customer_id")),
        }
    )
    items = silver["order_items"]
    items = items.unionByName(items.where(F.col("quantity") == 50)).withColumns(
        {
            "product_id": F.when(F.col("quantity") != 1, F.col("product_id")),
            "order_id": F.when(F.col("quantity") == 2, "ORD-UNKNOWN").otherwise(F.col("order_id")),
            "line_amount": F.when(F.col("quantity") == 3, -F.col("line_amount")).otherwise(
                F.col("line_amount")
            ),
        }
    )
    method = F.col("payment_method")
    payments = silver["payments"].withColumns(
        {
            "payment_method": F.when(method == "bank_transfer", "cheque").otherwise(method),
            "payment_amount": F.when(method == "card", F.col("payment_amount") + 1)
            .otherwise(F.col("payment_amount"))
            .cast("decimal(12,2)"),
            "order_id": F.when(F.minute("payment_timestamp") != 11, F.col("order_id")),
        }
    )
    events = silver["campaign_events"].withColumn(
        "revenue",
        F.when(F.col("channel") == "affiliate", -F.col("revenue")).otherwise(F.col("revenue")),
    )
    return {
        "customers": customers,
        "products": products,
        "orders": orders,
        "order_items": items,
        "payments": payments,
        "campaign_events": events,
    }
