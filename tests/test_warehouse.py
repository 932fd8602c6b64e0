from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopledger.operators import SkewPolicy
from shopledger.plans import marts, runs
from shopledger.plans.warehouse import (
    WarehouseLoadError,
    build_warehouse,
    fact_sales,
    load_assertions,
    require_loaded,
)
from tests.data import at, silver
from tests.disk import left_behind, shuffle_files
from verification import queries


def loaded(tables, warehouse=None):
    return load_assertions(tables, warehouse or build_warehouse(tables)).first().asDict()


def test_facts_equal_the_dimension_joins(spark):
    """Keys derived in place are those of the joined dimensions."""
    tables = silver(spark)
    w = build_warehouse(tables)
    joined = (
        tables["order_items"]
        .join(tables["orders"].drop("updated_at"), "order_id")
        .join(tables["payments"].drop("updated_at"), "order_id")
        .join(w["dim_customer"].select("customer_id", "customer_key"), "customer_id")
        .join(w["dim_product"].select("product_id", "product_key"), "product_id")
        .join(w["dim_date"], F.to_date("order_timestamp") == F.col("calendar_date"))
    )
    columns = ["order_item_id", "customer_key", "product_key", "date_key", "quantity"]
    assert sorted(map(tuple, w["fact_sales"].select(columns).collect())) == sorted(
        map(tuple, joined.select(columns).collect())
    )
    events = (
        tables["campaign_events"]
        .join(w["dim_channel"], "channel")
        .join(w["dim_date"], F.to_date("event_timestamp") == F.col("calendar_date"))
        .select("event_id", "channel_key", "date_key")
    )
    derived = w["fact_campaign_events"].select("event_id", "channel_key", "date_key")
    assert sorted(map(tuple, derived.collect())) == sorted(map(tuple, events.collect()))


def test_digests_are_derived_after_the_joins(spark):
    """F16, F18: no shuffle of the facts carries a surrogate key."""
    for verified in (False, True):
        facts = build_warehouse(silver(spark), SkewPolicy(), verified=verified)
        for fact in ("fact_sales", "fact_campaign_events"):
            plan = facts[fact]._jdf.queryExecution().optimizedPlan().toString().splitlines()
            first = next((i for i, line in enumerate(plan) if "Join" in line), len(plan))
            assert any("md5" in line for line in plan[:first])
            assert not any("md5" in line for line in plan[first:])


def test_silver_that_one_fact_is_made_from_passes_unwritten(spark, monkeypatch):
    """F16: what only the sales facts read is neither written nor deduplicated apart."""
    sample, folders = queries.Sample(spark, "/root/testdata/sf0.001"), []
    real = queries.written

    def seen(spark, tables, folder):
        folders.append(set(tables))
        return real(spark, tables, folder)

    monkeypatch.setattr(queries, "written", seen)
    passing, whole = sample.staged("order_items", "payments"), sample.staged()
    assert folders[0] == {"customers", "products", "orders", "campaign_events"}
    for name, (_, df) in passing.objects.items():
        assert df.count() == whole.objects[name][1].count()


def test_verified_load_equals_the_joined_one(spark):
    tables = silver(spark)
    joined, derived = (build_warehouse(tables, verified=v) for v in (False, True))
    for fact in ("fact_sales", "fact_campaign_events"):
        assert joined[fact].columns == derived[fact].columns
        assert sorted(map(tuple, joined[fact].collect())) == sorted(
            map(tuple, derived[fact].collect())
        )
    plan = derived["fact_sales"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 2


@pytest.mark.parametrize("rows_per_task", [1, 2, 5])
def test_hot_orders_customers_and_products(spark, rows_per_task):
    """One order, customer and product with most of the rows."""
    orders = [(f"O{i}", "C1" if i % 5 else "C2", "paid", at(2), at(2)) for i in range(1, 16)]
    payments = [
        (f"Y{i}", "O1" if i < 6 else f"O{i}", "card", Decimal("1.00"), at(2), at(2))
        for i in range(1, 14)
    ]
    items = [
        (f"I{i}", "O1" if i % 3 else f"O{i % 16}", "P1" if i % 4 else "P2", 1,
         Decimal("2.00"), at(2), Decimal("2.00"))
        for i in range(60)
    ]
    tables = silver(spark, orders=orders, payments=payments, order_items=items)
    policy = SkewPolicy(split=True, rows_per_task=rows_per_task)
    plain, split = fact_sales(tables), fact_sales(tables, policy)
    assert plain.columns == split.columns
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.collect()))


def test_items_without_order_payment_or_dimension_are_left_out(spark):
    items = [
        ("I1", "O1", "P1", 3, Decimal("2.00"), at(2), Decimal("6.00")),
        ("I2", "O9", "P1", 1, Decimal("2.00"), at(2), Decimal("2.00")),
        ("I3", "O3", "P9", 1, Decimal("2.00"), at(2), Decimal("2.00")),
        ("I4", None, "P1", 1, Decimal("2.00"), at(2), Decimal("2.00")),
    ]
    orders = [
        ("O1", "C1", "paid", at(2), at(2)),
        ("O3", "C1", "paid", None, at(2)),
    ]
    keys = fact_sales(silver(spark, order_items=items, orders=orders)).select("sales_key")
    assert [r[0] for r in keys.collect()] == ["I1"]


def test_calendar(spark):
    tables = silver(spark)
    rows = {r["calendar_date"]: r for r in build_warehouse(tables)["dim_date"].collect()}
    assert set(rows) == {date(2026, 5, 2), date(2026, 5, 3), date(2026, 5, 4)}
    saturday, sunday, monday = (rows[date(2026, 5, d)] for d in (2, 3, 4))
    assert (saturday["day_of_week"], sunday["day_of_week"], monday["day_of_week"]) == (6, 0, 1)
    assert (saturday["is_weekend"], sunday["is_weekend"], monday["is_weekend"]) == (True, True, False)
    assert (monday["date_key"], monday["quarter"], monday["month_name"], monday["day_name"]) == (
        20260504,
        2,
        "May",
        "Monday",
    )


def test_load_is_accepted(spark):
    metrics = loaded(silver(spark))
    require_loaded(metrics)
    assert metrics["fact_sales_rows"] == metrics["distinct_sales_keys"] == 4
    assert metrics["silver_revenue"] == metrics["warehouse_revenue"] == Decimal("23.00")


def test_second_payment_of_an_order_is_refused(spark):
    payments = [(f"Y{i}", order, "card", Decimal("1.00"), at(2), at(2))
                for i, order in enumerate(["O1", "O1", "O2", "O3"])]
    with pytest.raises(WarehouseLoadError, match="duplicate"):
        require_loaded(loaded(silver(spark, payments=payments)))


def test_lost_revenue_is_refused(spark):
    payments = [("Y1", "O1", "card", Decimal("11.00"), at(2), at(2))]
    with pytest.raises(WarehouseLoadError, match="reconcile"):
        require_loaded(loaded(silver(spark, payments=payments)))


def test_empty_load_reconciles(spark):
    tables = silver(spark, order_items=[], campaign_events=[])
    metrics = loaded(tables)
    require_loaded(metrics)
    assert metrics["fact_sales_rows"] == 0


def test_colliding_keys_are_refused(spark):
    tables = silver(spark)
    w = build_warehouse(tables)
    w["dim_customer"] = w["dim_customer"].withColumn("customer_key", F.lit("1"))
    with pytest.raises(WarehouseLoadError, match="collide"):
        require_loaded(loaded(tables, w))


def test_marts(spark):
    m = marts.build_marts(build_warehouse(silver(spark)))
    assert [tuple(r) for r in m["vw_daily_sales"].collect()] == [
        (date(2026, 5, 2), Decimal("11.00"), 1, Decimal("11.00"), 4),
        (date(2026, 5, 3), Decimal("2.00"), 1, Decimal("2.00"), 1),
    ]
    assert tuple(m["vw_executive_summary"].first()) == (Decimal("13.00"), 2, Decimal("6.50"), 5)
    assert [tuple(r) for r in m["vw_customer_segments"].collect()] == [("new", 1, 2, Decimal("13.00"))]
    assert sorted(tuple(r) for r in m["vw_product_performance"].collect()) == [
        ("Office", "pad", Decimal("5.00"), 1, 1),
        ("Office", "pen", Decimal("8.00"), 4, 2),
    ]
    assert [tuple(r) for r in m["vw_campaign_performance"].collect()] == [
        ("camp", "email", 2, 1, Decimal("6.00"), Decimal("33.33"))
    ]


def test_products_that_share_a_name_count_an_order_once(spark):
    products = [
        (p, "pen", "Office", Decimal("2.00"), True, at(1), at(1)) for p in ("P1", "P2")
    ]
    warehouse = build_warehouse(silver(spark, products=products))
    for policy in (SkewPolicy(), SkewPolicy(split=True, rows_per_task=1)):
        mart = marts.product_performance(
            warehouse["fact_sales"], warehouse["dim_product"], policy
        )
        assert [tuple(r) for r in mart.collect()] == [("Office", "pen", Decimal("13.00"), 5, 2)]


def test_empty_summary_has_no_average(spark):
    m = marts.build_marts(build_warehouse(silver(spark, order_items=[])))
    assert tuple(m["vw_executive_summary"].first()) == (None, 0, None, None)


def test_views_answer_sql(spark):
    marts.register_views(build_warehouse(silver(spark)))
    try:
        rows = spark.sql("SELECT orders, units FROM vw_daily_sales ORDER BY calendar_date").collect()
        assert [tuple(r) for r in rows] == [(1, 4), (1, 1)]
        objects = runs.catalog_objects(spark, ("dim_", "fact_", "vw_"))
        counts = {r["object_name"]: r["row_count"] for r in runs.object_counts(objects).collect()}
        assert len(counts) == 11
        assert counts["fact_sales"] == 4 and counts["vw_campaign_performance"] == 1
    finally:
        for name in (*build_warehouse(silver(spark)), *marts.MART_NAMES):
            spark.catalog.dropTempView(name)


def test_a_load_with_other_keys_is_not_idempotent(spark):
    tables = silver(spark)
    first = fact_sales(tables)
    assert runs.idempotency(first, fact_sales(tables)).first()["passed"]
    changed = runs.idempotency(first, first.where("sales_key <> 'I4'")).first()
    assert not changed["passed"] and changed["keys_only_in_first"] == 1
    doubled = runs.idempotency(first, first.union(first)).first()
    assert not doubled["passed"] and doubled["distinct_sales_keys"] == 4


def test_publishable_run_is_the_last_loaded_one(spark):
    ledger = spark.createDataFrame(
        [("old", at(1), 1, 1, "success"), ("good", at(2), 4, 3, "success")],
        "run_id string, loaded_at timestamp, fact_sales_rows long, fact_campaign_rows long, status string",
    )
    schema = (
        "run_id string, checked_at timestamp, check_name string, failures long, "
        "passed boolean, blocking boolean, detail string"
    )

    def verdict(*log):
        rows = [(run, at(day), "check", n, n == 0, True, "") for run, day, n in log]
        frame = runs.publishable_run(ledger, spark.createDataFrame(rows, schema))
        return [r["run_id"] for r in frame.collect()]

    assert verdict(("good", 2, 0), ("demo", 3, 5)) == ["good"]
    assert verdict(("old", 1, 0), ("good", 2, 1)) == []
    assert verdict(("old", 1, 0)) == []
    assert verdict(("good", 2, 1), ("good", 3, 0)) == ["good"]


def test_each_report_of_the_evidence_is_made_by_itself(spark):
    """the reports are written one by one, and what each shuffled is gone."""
    held = shuffle_files(spark)
    found = queries._evidence(queries.Sample(spark, "/root/testdata/sf0.001"))
    assert not left_behind(spark, held)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "sales_key" not in plan.replace("sales_keys", "")
    assert found.where("section = 'reconciliation'").count() == 8
