"""Small hand-made tables in Silver and source shape."""

from __future__ import annotations

from datetime import datetime, timezone
from decimal import Decimal

from shopledger.schemas import SILVER_SCHEMAS, SOURCE_SCHEMAS


def at(day: int, hour: int = 0) -> datetime:
    return datetime(2026, 5, day, hour, tzinfo=timezone.utc)


def silver(spark, **rows):
    """Six consistent Silver tables; a keyword replaces the rows of one."""
    tables = {
        "customers": [
            ("C1", "h1", "***-***-0001", "Rome", "new", at(1), at(1)),
            ("C2", "h2", "***-***-0002", "Oslo", "vip", at(1), at(1)),
        ],
        "products": [
            ("P1", "pen", "Office", Decimal("2.00"), True, at(1), at(1)),
            ("P2", "pad", "Office", Decimal("5.00"), True, at(1), at(1)),
        ],
        "orders": [
            ("O1", "C1", "completed", at(2, 9), at(2)),
            ("O2", "C2", "cancelled", at(2, 10), at(2)),
            ("O3", "C1", "paid", at(3, 11), at(3)),
        ],
        "order_items": [
            ("I1", "O1", "P1", 3, Decimal("2.00"), at(2), Decimal("6.00")),
            ("I2", "O1", "P2", 1, Decimal("5.00"), at(2), Decimal("5.00")),
            ("I3", "O2", "P2", 2, Decimal("5.00"), at(2), Decimal("10.00")),
            ("I4", "O3", "P1", 1, Decimal("2.00"), at(3), Decimal("2.00")),
        ],
        "payments": [
            ("Y1", "O1", "card", Decimal("11.00"), at(2, 9), at(2)),
            ("Y2", "O2", "wallet", Decimal("10.00"), at(2, 10), at(2)),
            ("Y3", "O3", "promptpay", Decimal("2.00"), at(3, 11), at(3)),
        ],
        "campaign_events": [
            ("E1", "camp", "email", "C1", "click", Decimal("0.00"), at(2), at(2)),
            ("E2", "camp", "email", "C1", "conversion", Decimal("6.00"), at(4), at(4)),
            ("E3", "camp", "email", "C2", "click", Decimal("0.00"), at(4), at(4)),
        ],
    }
    tables.update(rows)
    return {
        name: spark.createDataFrame(values, SILVER_SCHEMAS[name]) for name, values in tables.items()
    }


def source(spark, name, rows):
    return spark.createDataFrame(rows, SOURCE_SCHEMAS[name])
