"""Source and Silver schemas, keys and value domains."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_TEXT, _TIME = T.StringType(), T.TimestampType()

# Tables of the row store; the event feed is the sixth source.
SOURCE_TABLES = ("customers", "products", "orders", "order_items", "payments")
EVENT_SOURCE = "campaign_events"
SOURCES = (*SOURCE_TABLES, EVENT_SOURCE)

SOURCE_SCHEMAS = {
    "customers": _schema(
        customer_id=_TEXT,
        full_name=_TEXT,
        email=_TEXT,
        phone=_TEXT,
        address=_TEXT,
        city=_TEXT,
        customer_segment=_TEXT,
        created_at=_TIME,
        updated_at=_TIME,
    ),
    "products": _schema(
        product_id=_TEXT,
        product_name=_TEXT,
        category=_TEXT,
        unit_price=MONEY,
        is_active=T.BooleanType(),
        created_at=_TIME,
        updated_at=_TIME,
    ),
    "orders": _schema(
        order_id=_TEXT,
        customer_id=_TEXT,
        order_status=_TEXT,
        order_timestamp=_TIME,
        updated_at=_TIME,
    ),
    "order_items": _schema(
        order_item_id=_TEXT,
        order_id=_TEXT,
        product_id=_TEXT,
        quantity=T.IntegerType(),
        unit_price=MONEY,
        updated_at=_TIME,
    ),
    "payments": _schema(
        payment_id=_TEXT,
        order_id=_TEXT,
        payment_method=_TEXT,
        payment_amount=MONEY,
        payment_timestamp=_TIME,
        updated_at=_TIME,
    ),
    "campaign_events": _schema(
        event_id=_TEXT,
        campaign_id=_TEXT,
        channel=_TEXT,
        customer_id=_TEXT,
        event_type=_TEXT,
        revenue=T.DoubleType(),
        event_timestamp=_TIME,
        updated_at=_TIME,
    ),
}

# The feed is JSON lines with ISO-8601 text for times.
EVENT_FEED_SCHEMA = _schema(
    event_id=_TEXT,
    campaign_id=_TEXT,
    channel=_TEXT,
    customer_id=_TEXT,
    event_type=_TEXT,
    revenue=T.DoubleType(),
    event_timestamp=_TEXT,
    updated_at=_TEXT,
)

# A line of the feed that is no event, kept as it came.
REJECTED_RECORD = "rejected_record"

SILVER_SCHEMAS = {
    "customers": _schema(
        customer_id=_TEXT,
        email_hash=_TEXT,
        phone_masked=_TEXT,
        customer_city=_TEXT,
        customer_segment=_TEXT,
        created_at=_TIME,
        updated_at=_TIME,
    ),
    "products": SOURCE_SCHEMAS["products"],
    "orders": SOURCE_SCHEMAS["orders"],
    "order_items": T.StructType(
        [*SOURCE_SCHEMAS["order_items"].fields, T.StructField("line_amount", MONEY)]
    ),
    "payments": SOURCE_SCHEMAS["payments"],
    "campaign_events": T.StructType(
        [
            T.StructField(f.name, MONEY if f.name == "revenue" else f.dataType)
            for f in SOURCE_SCHEMAS["campaign_events"].fields
        ]
    ),
}

_INT = T.IntegerType()
FACT_TABLES = ("fact_sales", "fact_campaign_events")
WAREHOUSE_SCHEMAS = {
    "dim_customer": T.StructType(
        [T.StructField("customer_key", _TEXT), *SILVER_SCHEMAS["customers"].fields]
    ),
    "dim_product": _schema(
        product_key=_TEXT,
        product_id=_TEXT,
        product_name=_TEXT,
        category=_TEXT,
        current_unit_price=MONEY,
        is_active=T.BooleanType(),
        created_at=_TIME,
        updated_at=_TIME,
    ),
    "dim_date": _schema(
        date_key=_INT,
        calendar_date=T.DateType(),
        year=_INT,
        quarter=_INT,
        month=_INT,
        month_name=_TEXT,
        day=_INT,
        day_of_week=_INT,
        day_name=_TEXT,
        is_weekend=T.BooleanType(),
    ),
    "dim_channel": _schema(channel_key=_TEXT, channel=_TEXT),
    "fact_sales": _schema(
        sales_key=_TEXT,
        order_item_id=_TEXT,
        order_id=_TEXT,
        customer_key=_TEXT,
        product_key=_TEXT,
        date_key=_INT,
        order_status=_TEXT,
        payment_method=_TEXT,
        quantity=_INT,
        unit_price=MONEY,
        gross_amount=MONEY,
        order_timestamp=_TIME,
        payment_timestamp=_TIME,
    ),
    "fact_campaign_events": _schema(
        campaign_event_key=_TEXT,
        event_id=_TEXT,
        campaign_id=_TEXT,
        customer_key=_TEXT,
        channel_key=_TEXT,
        date_key=_INT,
        event_type=_TEXT,
        revenue=MONEY,
        event_timestamp=_TIME,
    ),
}

# Columns of one extra order-item file that may be put in front of the gate.
ITEM_FIXTURE_SCHEMA = SILVER_SCHEMAS["order_items"]

PRIMARY_KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "payments": "payment_id",
    "campaign_events": "event_id",
}

# Fixed values.
ORDER_STATUSES = ("pending", "paid", "shipped", "completed", "cancelled")
PAYMENT_METHODS = ("card", "promptpay", "bank_transfer", "wallet")
EVENT_TYPES = ("click", "conversion")
RAW_PERSONAL_COLUMNS = ("full_name", "email", "phone", "address")
PROTECTED_COLUMNS = ("email_hash", "phone_masked")
EPOCH_WATERMARK = "1970-01-01T00:00:00+00:00"
MINIMUM_ROWS = {"customers": 100, "products": 50, "orders": 500}
AMOUNT_TOLERANCE = "0.01"

LEDGER_SCHEMA = _schema(
    run_id=_TEXT,
    loaded_at=_TIME,
    fact_sales_rows=T.LongType(),
    fact_campaign_rows=T.LongType(),
    status=_TEXT,
)
# A row is written after its batch, so a batch that is named here is complete.
WATERMARK_SCHEMA = _schema(
    watermark=_TIME, run_id=_TEXT, ingested_date=T.DateType(), batch=_TEXT, rejected=T.LongType()
)
QUALITY_LOG_SCHEMA = _schema(
    run_id=_TEXT,
    checked_at=_TIME,
    check_name=_TEXT,
    failures=T.LongType(),
    passed=T.BooleanType(),
    blocking=T.BooleanType(),
    detail=_TEXT,
)
# One row per layer; rows of one commit are one file, named by its number. The counts
# are those of a load.
PUBLISH_LOG_SCHEMA = _schema(
    number=T.LongType(),
    layer=_TEXT,
    run_id=_TEXT,
    slot=_TEXT,
    published_at=_TIME,
    fact_sales_rows=T.LongType(),
    fact_campaign_rows=T.LongType(),
)
