"""A run that merges changes gives what a rebuild gives, and touches only what changed."""

from __future__ import annotations

import re
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shopledger.plans import marts, pipeline, quality
from shopledger.plans.states import STATES
from shopledger.plans.warehouse import build_warehouse
from shopledger.schemas import SOURCES
from shopledger.sources import lake as store
from shopledger.sources.lake import Lake
from tests.data import at, source
from tests.disk import left_behind, shuffle_files
from verification import queries

LOW = {"customers": 1, "products": 1, "orders": 1}
ORDERS = 24


def tables(**later):
    """Source rows of a small shop; a keyword adds rows to a table."""
    rows = {
        "customers": [(f"C{i}", f"n{i}", f"e{i}@x", f"555-000{i}", "a", "Rome", "new" if i % 2 else "vip", at(1), at(1)) for i in range(4)],
        "products": [(f"P{i}", f"pen {i % 2}", "Office", Decimal("2.00"), True, at(1), at(1)) for i in range(3)],
        "orders": [(f"O{i}", f"C{i % 4}", " PAID" if i % 5 else "cancelled", at(2 + i % 4, 9), at(2 + i % 4)) for i in range(ORDERS)],
        "order_items": [(f"I{i}-{k}", f"O{i}", f"P{(i + k) % 3}", k + 1, Decimal("2.00"), at(2 + i % 4)) for i in range(ORDERS) for k in range(2)],
        "payments": [(f"Y{i}", f"O{i}", "Card", Decimal("6.00"), at(2 + i % 4, 9), at(2 + i % 4)) for i in range(ORDERS)],
        "campaign_events": [(f"E{i}", f"camp{i % 2}", "Email" if i % 3 else "web", f"C{i % 4}", "click", 0.5, at(2 + i % 4), at(2 + i % 4)) for i in range(12)],
    }
    return {name: [*own, *later.get(name, [])] for name, own in rows.items()}


def sources(spark, **later):
    return {name: source(spark, name, rows) for name, rows in tables(**later).items()}


# The third order moves to a day of its own, another changes its customer, one is
# cancelled, one is new; an item moves to another order, and payments follow the totals.
SECOND = {
    "orders": [
        ("O2", "C2", "paid", at(20, 9), at(10)),
        ("O3", "C0", "shipped", at(5, 9), at(10)),
        ("O4", "C0", "cancelled", at(2, 9), at(10)),
        ("O99", "C1", "paid", at(21, 1), at(10)),
        ("O5", "C3", "paid", at(30), at(2, 0)),  # extracted late, and older than what is there
    ],
    "order_items": [
        ("I6-1", "O7", "P1", 2, Decimal("2.00"), at(10)),
        ("I99-0", "O99", "P0", 3, Decimal("2.00"), at(10)),
        ("I8-0", "O8", "P2", 5, Decimal("2.00"), at(10)),
    ],
    "payments": [
        ("Y6", "O6", "card", Decimal("2.00"), at(4, 9), at(10)),
        ("Y7", "O7", "wallet", Decimal("10.00"), at(5, 9), at(10)),
        ("Y8", "O8", "card", Decimal("14.00"), at(2, 9), at(10)),
        ("Y99", "O99", "card", Decimal("6.00"), at(21, 1), at(10)),
    ],
    "campaign_events": [
        ("E1", "camp1", "web", "C1", "conversion", 9.25, at(25), at(10)),
        ("E50", "camp9", "tv", "C1", "click", 0.0, at(26), at(10)),
    ],
    "customers": [("C3", "n3", "e3@x", "555-0003", "a", "Oslo", "vip", at(1), at(10))],
}
THIRD = {
    **SECOND,
    "products": [("P2", "pencil", "School", Decimal("3.00"), True, at(1), at(12))],
    "campaign_events": [*SECOND["campaign_events"], ("E50", "camp9", "web", "C1", "click", 0.0, at(3), at(12))],
    "orders": [*SECOND["orders"], ("O99", "C1", "cancelled", at(21, 1), at(12))],
}


def rows(df):
    return sorted((tuple(map(str, r)) for r in df.select(sorted(df.columns)).collect()))


def run(spark, lake, later, name, **options):
    # Reading back two weeks brings the late row and repeats many others.
    return pipeline.run(
        spark, lake, sources(spark, **later), salt="s", run_id=name, minimum_rows=LOW, lookback=timedelta(days=14), **options
    )


@pytest.fixture(scope="module")
def lakes(spark, tmp_path_factory):
    """A lake that three runs changed step by step, and one rebuilt from all batches."""
    lake = Lake(str(tmp_path_factory.mktemp("lake")), buckets=5)
    reports = [run(spark, lake, later, f"r{i}") for i, later in enumerate(({}, SECOND, THIRD))]
    return lake, reports


def test_runs_after_the_first_merge(lakes):
    _, reports = lakes
    assert [r["warehouse"]["incremental"] for r in reports] == [False, True, True]
    assert [r["warehouse"]["publication"] for r in reports] == [1, 2, 3]


def test_silver_equals_a_rebuild(spark, lakes):
    lake, reports = lakes
    live = pipeline.live_silver(spark, lake)
    bronze = {name: store.read_bronze(spark, lake, name) for name in SOURCES}
    whole = pipeline.build_silver(bronze, salt="s")
    for name in SOURCES:
        assert rows(live[name]) == rows(whole[name]), name
    late = live["orders"].where("order_id = 'O5'").first()
    assert late["order_timestamp"] == at(3, 9).replace(tzinfo=None)
    assert reports[2]["transform"]["counts"]["orders"] == ORDERS + 1


def test_observed_measures_are_those_of_a_scan(spark, lakes):
    lake, _ = lakes
    version = store.live_version(spark, lake, "silver")
    silver = pipeline.live_silver(spark, lake)
    checks = [*quality.ROW_CHECKS, quality.MINIMUM_VOLUME]
    limits = {"orders": ORDERS + 2, "customers": 4}
    seen = quality.measured_failures(spark, version.measures, checks, limits)
    assert rows(seen) == rows(quality.table_failures(silver, checks, limits))
    plan = quality.check_frame(silver, checks, limits, measures=version.measures)
    assert "FileScan parquet" not in plan.where("check_name <> 'x'")._jdf.queryExecution().executedPlan().toString()


def test_facts_equal_a_full_load(spark, lakes):
    lake, _ = lakes
    live, whole = pipeline.live_warehouse(spark, lake), build_warehouse(pipeline.live_silver(spark, lake))
    for name, df in whole.items():
        assert rows(live[name]) == rows(df), name
    parts = store.live_version(spark, lake, "warehouse").parts["fact_sales"]
    assert 20260520 in parts and 20260521 in parts


def test_marts_of_states_equal_recomputed_ones(spark, lakes):
    lake, _ = lakes
    warehouse = pipeline.live_warehouse(spark, lake)
    whole = marts.build_marts(warehouse)
    for name, df in pipeline.state_marts(warehouse).items():
        assert rows(df) == rows(whole[name]), name
    assert set(STATES) <= set(warehouse)


def test_only_touched_parts_are_written(spark, lakes):
    lake, reports = lakes
    versions = [store.load_version(spark, lake, "warehouse", r["warehouse"]["slot"]) for r in reports]
    sales = [v.parts["fact_sales"] for v in versions]
    own = {d for d, s in sales[1].items() if s == versions[1].slot}
    # Days of O2 (old and new), O3, O4, O6, O7, O8 and the new O99 ...
    assert own == {20260520, 20260521, *(20260502 + i % 4 for i in (2, 3, 4, 6, 7, 8))}
    # ... and in the third run the day of the cancelled order alone.
    assert {d for d, s in sales[2].items() if s == versions[2].slot} == {20260521}
    silver = store.live_version(spark, lake, "silver")
    assert silver.changed == set(SOURCES)  # everything was read again, little had changed
    assert silver.slot not in silver.parts["order_items"].values()
    assert len({s for s in silver.parts["orders"].values()}) > 1
    older = pipeline.read_warehouse(spark, lake, reports[0]["warehouse"]["slot"])
    assert older["fact_sales"].count() == 2 * ORDERS


def test_a_merge_reads_new_batches_and_touched_buckets(spark, lakes, monkeypatch, tmp_path):
    lake, _ = lakes
    base = store.live_version(spark, lake, "silver")
    batches = pipeline.complete_batches(spark, lake)
    batch = source(spark, "orders", [("O1", "C1", "shipped", at(3, 9), at(13))])
    pipeline.extract_source(spark, lake, "orders", batch, run_id="extra", watermark=at(12))
    folders = pipeline.complete_batches(spark, lake)
    (new,) = set(folders) - set(batches)
    read = []
    parts_read, batches_read = store.PartTable.read, store.read_batches

    def seen_parts(self, spark, parts, *sizes):
        read.append((self.name, dict(parts)))
        return parts_read(self, spark, parts, *sizes)

    def seen_batches(spark, lake, name, wanted):
        df = batches_read(spark, lake, name, wanted)
        read.append(("bronze", df.inputFiles()))
        return df

    monkeypatch.setattr(store.PartTable, "read", seen_parts)
    monkeypatch.setattr(store, "read_batches", seen_batches)
    merged = pipeline.merge_silver(spark, lake, base, store.new_slot("extra"), batches=folders, salt="s")
    (bronze,) = [found for name, found in read if name == "bronze"]
    assert len(bronze) == 1 and f"batch={new[1]}" in bronze[0]
    buckets = [parts for name, parts in read if name == "orders"]
    assert buckets and all(len(parts) == 1 for parts in buckets)
    assert {name for name, _ in read} == {"bronze", "orders"}
    moved = {b for b, s in merged.parts["orders"].items() if s == merged.slot}
    assert moved == set(buckets[0]) and merged.origin == base.slot


def test_of_two_runs_on_one_base_the_second_is_refused(spark, lakes, monkeypatch):
    lake, _ = lakes
    before = store.newest_number(spark, lake)
    assert store.publish_slots(spark, lake, {"other": "a"}, run_id="a", at=at(1), base=before) == before + 1
    with pytest.raises(store.StaleBaseError, match=str(before)):
        store.publish_slots(spark, lake, {"other": "b"}, run_id="b", at=at(2), base=before)
    assert store.live_slot(spark, lake, "other") == "a"

    # A run publishes while another one is between its base and its commit.
    silver = store.live_slot(spark, lake, "silver")
    loading = pipeline.load_assertions

    def meanwhile(*args):
        monkeypatch.setattr(pipeline, "load_assertions", loading)
        run(spark, lake, THIRD, "inner")
        return loading(*args)

    monkeypatch.setattr(pipeline, "load_assertions", meanwhile)
    with pytest.raises(store.StaleBaseError, match="outer"):
        run(spark, lake, THIRD, "outer")
    live = store.live_publication(spark, lake, "silver")
    assert live["run_id"] == "inner" and live["slot"] != silver
    assert store.live_publication(spark, lake, "warehouse")["run_id"] == "inner"


def test_a_date_filter_prunes_days_through_the_join(spark, lakes):
    lake, _ = lakes
    warehouse = pipeline.live_warehouse(spark, lake)
    days = warehouse["dim_date"].where(F.col("day") == 3)
    daily = marts.day_totals(warehouse["fact_sales"].join(F.broadcast(days.select("date_key")), "date_key"))
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dynamicpruning", plan)
    direct = warehouse["fact_sales"].where("date_key = 20260503")
    assert re.search(r"PartitionFilters: \[[^\]]*date_key", direct._jdf.queryExecution().executedPlan().toString())


def test_a_hot_day_is_written_by_several_tasks(spark, tmp_path):
    lake = Lake(str(tmp_path))
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    table = lake.warehouse("fact_campaign_events")
    many = spark.range(0, 200_000, 1, 8).selectExpr(
        "sha2(cast(id AS string), 256) AS campaign_event_key", "cast(id AS string) AS event_id", "'c' AS campaign_id",
        "sha2(cast(-id AS string), 256) AS customer_key", "'k' AS channel_key", "IF(id % 1000 = 0, 20260102, 20260101) AS date_key",
        "'click' AS event_type", "cast(1 AS decimal(12,2)) AS revenue", "timestamp '2026-01-01 00:00:00' AS event_timestamp",
    )
    try:
        spark.conf.set(name, "2m")
        table.write(many, "s")
    finally:
        spark.conf.set(name, before)
    files = {day: len(list((tmp_path / "warehouse" / "fact_campaign_events" / "slot=s" / f"date_key={day}").glob("*.parquet"))) for day in (20260101, 20260102)}
    assert 3 <= files[20260101] <= 40 and files[20260102] <= 8
    assert table.written(spark, "s") == [20260101, 20260102]
    assert table.read(spark, {20260101: "s", 20260102: "s"}).count() == 200_000


def test_an_increment_holds_the_shuffles_of_one_table(spark, monkeypatch):
    """tables are written one by one, and what each shuffled is gone."""
    held, folders = shuffle_files(spark), []
    real = queries.written

    def seen(spark, tables, folder):
        folders.append(list(tables))
        return real(spark, tables, folder)

    monkeypatch.setattr(queries, "written", seen)
    queries.Increment(queries.Sample(spark, "/root/testdata/sf0.001"))
    assert folders == [["payments"], *([name] for name in [*SOURCES, *SOURCES])]
    assert not left_behind(spark, held)
