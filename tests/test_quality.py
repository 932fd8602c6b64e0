from __future__ import annotations

import re
from decimal import Decimal

import pytest

from shopledger.operators import SkewPolicy
from shopledger.plans import quality
from shopledger.sources.inputs import read_item_fixture
from tests.data import at, silver

LOW = {"customers": 1, "products": 1, "orders": 1}


def failures(tables, minimum=LOW):
    rows = quality.check_frame(tables, minimum_rows=minimum).collect()
    assert {r["check_name"] for r in rows} == set(quality.CHECKS)
    assert all(r["passed"] == (r["failures"] == 0) and r["blocking"] for r in rows)
    return {r["check_name"]: r["failures"] for r in rows if r["failures"]}


def test_consistent_tables_pass(spark):
    assert failures(silver(spark)) == {}
    report = quality.run_gate(silver(spark), run_id="r", minimum_rows=LOW)
    assert report["status"] == "passed" and report["blocking_failures"] == 0
    assert [c["check_name"] for c in report["checks"]] == list(quality.CHECKS)


def test_null_key_is_missing_and_a_duplicate_and_an_orphan(spark):
    payments = [
        ("Y1", "O1", "card", Decimal("11.00"), at(2), at(2)),
        (None, None, "card", Decimal("1.00"), at(2), at(2)),
    ]
    assert failures(silver(spark, payments=payments)) == {
        quality.REQUIRED_KEYS: 1,
        quality.UNIQUE_KEYS: 1,
        quality.REFERENTIAL_INTEGRITY: 1,
    }


def test_duplicate_key(spark):
    products = [("P1", "pen", "Office", Decimal("2.00"), True, at(1), at(1))] * 3
    products.append(("P2", "pad", "Office", Decimal("5.00"), True, at(1), at(1)))
    assert failures(silver(spark, products=products)) == {quality.UNIQUE_KEYS: 2}


def test_unknown_status_fails_and_null_status_passes(spark):
    orders = [
        ("O1", "C1", "lost", at(2), at(2)),
        ("O2", "C2", None, at(2), at(2)),
        ("O3", "C1", "paid", at(3), at(3)),
    ]
    assert failures(silver(spark, orders=orders)) == {quality.BUSINESS_STATUSES: 1}


def test_amounts(spark):
    events = [
        ("E1", "camp", "email", "C1", "click", Decimal("0.00"), at(2), at(2)),
        ("E2", "camp", "email", "C1", "click", Decimal("-1.00"), at(2), at(2)),
        ("E3", "camp", "email", "C1", "click", None, at(2), at(2)),
    ]
    assert failures(silver(spark, campaign_events=events)) == {quality.POSITIVE_AMOUNTS: 1}


def test_orphans_are_counted_per_child_row(spark):
    tables = silver(spark, customers=[("C2", "h", "m", "Oslo", "vip", at(1), at(1))])
    by_relation = {
        r["relationship"]: r["failures"] for r in quality.orphans_by_relationship(tables).collect()
    }
    assert by_relation == {
        "orders.customer_id -> customers": 2,
        "order_items.order_id -> orders": 0,
        "order_items.product_id -> products": 0,
        "payments.order_id -> orders": 0,
        "campaign_events.customer_id -> customers": 2,
    }
    assert failures(tables) == {quality.REFERENTIAL_INTEGRITY: 4}


@pytest.mark.parametrize("amount, expected", [("11.01", 0), ("11.02", 1), ("10.98", 1), (None, 0)])
def test_payment_tolerance(spark, amount, expected):
    value = Decimal(amount) if amount else None
    payments = [("Y1", "O1", "card", value, at(2), at(2))]
    found = failures(silver(spark, payments=payments))
    assert found == ({quality.PAYMENT_RECONCILES: 1} if expected else {})


def test_order_with_most_of_the_payments(spark):
    """Splitting a hot order changes no result."""
    payments = [
        (f"Y{i}", "O1" if i % 4 else "O3", "card", Decimal(i % 13), at(2), at(2)) for i in range(80)
    ]
    tables = silver(spark, payments=payments)
    plain, split = (
        quality.payment_mismatches(tables["payments"], tables["order_items"], policy)
        for policy in (SkewPolicy(), SkewPolicy(split=True, rows_per_task=7))
    )
    expected = sorted(r["payment_id"] for r in plain.collect())
    wrong = [p for p in payments if p[3] != (11 if p[1] == "O1" else 2)]
    assert expected == sorted(p[0] for p in wrong)
    assert sorted(r["payment_id"] for r in split.collect()) == expected


def test_payment_without_items_is_not_a_mismatch(spark):
    items = [("I1", "O1", "P1", 3, Decimal("2.00"), at(2), Decimal("11.00"))]
    assert failures(silver(spark, order_items=items)) == {}


def test_volume_counts_tables_below_their_minimum(spark):
    minimum = {"customers": 3, "products": 2, "orders": 4}
    assert failures(silver(spark), minimum) == {quality.MINIMUM_VOLUME: 2}


def test_raw_columns_are_found_by_name(spark):
    tables = silver(spark)
    tables["customers"] = tables["customers"].selectExpr("*", "'a' AS Email", "'b' AS address")
    report = quality.run_gate(tables, run_id="r", minimum_rows=LOW, raise_on_failure=False)
    check = next(c for c in report["checks"] if c["check_name"] == quality.RAW_PII_ABSENT)
    assert check["failures"] == 2
    assert check["detail"] == "Personal data in Silver: address, email"


def test_bad_fixture_is_blocked(spark, tmp_path):
    path = tmp_path / "bad_items.csv"
    path.write_text(
        "order_item_id,order_id,product_id,quantity,unit_price,updated_at,line_amount\n"
        "BAD1,O1,P999,-2,100.00,2026-06-01T00:00:00+00:00,-200.00\n"
    )
    fixture = read_item_fixture(spark, str(path))
    report = quality.run_gate(
        silver(spark), run_id="bad", item_fixture=fixture, minimum_rows=LOW, raise_on_failure=False
    )
    assert report["status"] == "failed"
    assert report["failed"] == [
        quality.POSITIVE_AMOUNTS,
        quality.REFERENTIAL_INTEGRITY,
        quality.PAYMENT_RECONCILES,
    ]
    with pytest.raises(quality.QualityGateError, match="positive_amounts"):
        quality.run_gate(silver(spark), run_id="bad", item_fixture=fixture, minimum_rows=LOW)


def test_row_checks_scan_each_table_once(spark, tmp_path):
    tables = {}
    for name, df in silver(spark).items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
    # Keys are counted by a scan of their own, so that their shuffle carries nothing else.
    rows = [*quality.ROW_CHECKS, quality.MINIMUM_VOLUME]
    for checks, scans in ((rows, 1), ([*rows, quality.UNIQUE_KEYS], 2)):
        plan = quality.check_frame(tables, checks)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == scans * len(tables)


def test_items_are_shuffled_once_by_their_order(spark, tmp_path):
    """Orphans of orders and the reconciliation come from one aggregate of the items."""
    tables = {}
    for name, df in silver(spark).items():
        df.write.parquet(str(tmp_path / name))
        tables[name] = spark.read.schema(df.schema).parquet(str(tmp_path / name))
    checks = [quality.REFERENTIAL_INTEGRITY, quality.PAYMENT_RECONCILES]
    plan = quality.check_frame(tables, checks)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*", plan)
    items = [s for s in scans if "order_id" in s and "line_amount" in s]
    assert len(items) == 1 and sum("payment_amount" in s for s in scans) == 2
    assert len(scans) == 3 + 4 + 2 and "Join" not in plan
    assert plan.count("partial_sum") and "partial_max" in plan


def test_payments_of_a_hot_order_by_amount(spark):
    """Amounts a cent off agree, a second payment of an order counts by itself, and
    payments without an order are not compared."""
    payments = [(f"Y{i}", "O1", "card", Decimal(1095 + i % 11) / 100, at(2), at(2)) for i in range(110)]
    payments += [("Z1", "O3", "card", Decimal("2.00"), at(2), at(2)), ("Z2", "O3", "card", Decimal("3.00"), at(2), at(2))]
    payments += [("Z3", None, "card", Decimal("2.00"), at(2), at(2)), ("Z4", "O9", "card", Decimal("2.00"), at(2), at(2))]
    tables = silver(spark, payments=payments)
    found = failures(tables)
    assert found[quality.PAYMENT_RECONCILES] == 80 + 1
    listed = quality.payment_mismatches(tables["payments"], tables["order_items"])
    assert listed.count() == 81 and found[quality.REFERENTIAL_INTEGRITY] == 2


def test_orphans_use_an_anti_join_on_combined_keys(spark):
    tables = silver(spark)
    plan = quality.orphans(tables["orders"], tables["customers"], "customer_id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" in text and "partial_count" in text
