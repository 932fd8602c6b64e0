from __future__ import annotations

import hashlib
from datetime import datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopledger.functions import date_key, surrogate_key, utc_timestamps
from shopledger.operators import changed_since, latest_by_key, ordered_page, upsert_by_key
from shopledger.plans.silver import changes, silver_table
from tests.data import at, source


def _customer(key, email, phone, updated):
    return (key, "Ann Name", email, phone, "1 Road", "Rome", "new", at(1), updated)


def test_customers_are_protected(spark):
    bronze = source(
        spark,
        "customers",
        [_customer("C1", "ann@example.com", "+66-02-555-0042", at(1))],
    )
    silver = silver_table("customers", bronze, salt="pepper")
    row = silver.first()
    assert row["email_hash"] == hashlib.sha256(b"ann@example.com:pepper").hexdigest()
    assert row["phone_masked"] == "***-***-0042"
    assert row["customer_city"] == "Rome"
    assert not set(silver.columns) & {"full_name", "email", "phone", "address", "city"}


def test_missing_contact_details_stay_missing(spark):
    bronze = source(
        spark,
        "customers",
        [_customer("C1", None, None, at(1)), _customer("C2", None, "42", at(1))],
    )
    rows = {r["customer_id"]: r for r in silver_table("customers", bronze, salt="x").collect()}
    assert rows["C1"]["email_hash"] is None and rows["C1"]["phone_masked"] is None
    assert rows["C2"]["phone_masked"] == "***-***-42"


def test_text_is_trimmed_and_lowered(spark):
    orders = source(spark, "orders", [("O1", "C1", "  Shipped ", at(1), at(1))])
    assert silver_table("orders", orders, salt="x").first()["order_status"] == "shipped"


def test_line_amount_is_exact(spark):
    items = source(spark, "order_items", [("I1", "O1", "P1", 3, Decimal("0.10"), at(1))])
    assert silver_table("order_items", items, salt="x").first()["line_amount"] == Decimal("0.30")


def test_latest_snapshot_wins(spark):
    orders = source(
        spark,
        "orders",
        [
            ("O1", "C1", "paid", at(1), at(1)),
            ("O1", "C1", "shipped", at(1), at(3)),
            ("O1", "C1", "pending", at(1), at(2)),
            ("O2", "C1", "paid", at(1), None),
        ],
    )
    rows = {r["order_id"]: r["order_status"] for r in silver_table("orders", orders, salt="x").collect()}
    assert rows == {"O1": "shipped", "O2": "paid"}


def test_ties_do_not_depend_on_order(spark):
    rows = [("k", 1, "b", None), ("k", 1, "a", 9), ("k", 1, "b", 3), (None, 1, "n", 1)]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "id string, t int, x string, y int").repartition(3)
        result = sorted(latest_by_key(df, ["id"], ["t"]).collect(), key=str)
        assert [tuple(r) for r in result] == [("k", 1, "b", 3), (None, 1, "n", 1)]


def test_latest_combines_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = latest_by_key(df, ["k"], ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and plan.count("Exchange") == 1


def test_watermark_is_strict_and_lookback_reaches_back(spark):
    from datetime import timedelta

    df = source(spark, "orders", [(f"O{d}", "C1", "paid", at(d), at(d)) for d in (1, 2, 3)])
    assert {r["order_id"] for r in changed_since(df, at(2)).collect()} == {"O3"}
    late = changed_since(df, at(2), lookback=timedelta(days=1))
    assert {r["order_id"] for r in late.collect()} == {"O2", "O3"}
    assert changed_since(df).count() == 3


def test_offsets_are_normalised_to_utc(spark):
    df = spark.createDataFrame(
        [("a", "2026-05-01T06:30:00+07:00", "kept")], "id string, made_at string, note string"
    )
    row = utc_timestamps(df).select(F.unix_timestamp("made_at").alias("s"), "note").first()
    assert row["s"] == int(datetime(2026, 4, 30, 23, 30, tzinfo=timezone.utc).timestamp())
    assert row["note"] == "kept"


def test_surrogate_key_is_stable(spark):
    row = spark.sql("SELECT 'CUST000000001' AS k").select(surrogate_key("k").alias("v")).first()
    assert row["v"] == hashlib.md5(b"CUST000000001").hexdigest()


def test_date_key(spark):
    row = spark.sql("SELECT DATE '2026-05-09' AS d").select(date_key(F.col("d")).alias("k")).first()
    assert row["k"] == 20260509


def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "id string, n int")
    rows = sorted(tuple(r) for r in upsert_by_key(old, new, ["id"]).collect())
    assert rows == [("a", 1), ("b", 3), ("c", 4)]


def test_pages_cover_the_feed_once(spark):
    feed = spark.range(25).select((F.col("id") * 7 % 25).alias("n"))
    pages = [ordered_page(feed, ["n"], offset=o, limit=10) for o in (0, 10, 20)]
    seen = [r["n"] for page in pages for r in page.orderBy("n").collect()]
    assert seen == list(range(25))
    assert [page.first()["has_more"] for page in pages] == [True, True, False]
    assert pages[0].first()["total"] == 25


@pytest.mark.parametrize("offset, limit", [(-1, 10), (0, 0), (0, 501)])
def test_page_bounds_are_checked(spark, offset, limit):
    with pytest.raises(ValueError):
        ordered_page(spark.range(1), ["id"], offset=offset, limit=limit)


def test_changes_meet_without_dealing_the_incoming_rows_again(spark):
    current = silver_table("order_items", source(spark, "order_items", [
        ("I1", "O1", "P1", 1, Decimal("2.00"), at(1)),
        ("I2", "O1", "P1", 1, Decimal("2.00"), at(1)),
        ("I3", "O1", "P1", 1, Decimal("2.00"), at(5)),
        (None, "O1", "P1", 1, Decimal("2.00"), at(1)),
    ]), salt="s")
    incoming = silver_table("order_items", source(spark, "order_items", [
        ("I1", "O1", "P1", 1, Decimal("2.00"), at(1)),
        ("I2", "O1", "P1", 7, Decimal("2.00"), at(2)),
        ("I3", "O1", "P1", 7, Decimal("2.00"), at(2)),
        ("I4", "O2", "P1", 1, Decimal("2.00"), at(2)),
        (None, "O3", "P1", 1, Decimal("2.00"), at(2)),
        (None, "O2", "P1", 1, Decimal("2.00"), at(2)),
    ]), salt="s")
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        met = changes("order_items", current, incoming)
        rows = {r["now"]["order_item_id"]: (r["was"] and r["was"]["order_id"], r["now"]["order_id"]) for r in met.collect()}
        plan = met._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert rows == {"I2": ("O1", "O1"), "I4": (None, "O2"), None: ("O1", "O3")}
    # The aggregates' own shuffles by key are the only ones of the incoming rows.
    assert "coalesce(" not in plan
