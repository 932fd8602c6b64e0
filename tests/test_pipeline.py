from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone
from decimal import Decimal

import pyarrow.parquet as parquet
import pytest
from pyspark.sql import functions as F

from shopledger.plans import pipeline, quality
from shopledger.schemas import SILVER_SCHEMAS, SOURCES
from shopledger.sources import inputs, lake as store
from shopledger.sources.lake import Lake
from shopledger.sources.sample import sample_sources
from tests.data import at, source

FOLDER = "/root/testdata/sf0.001"
ITEMS = 4599


@pytest.fixture(scope="module")
def sources(spark):
    return sample_sources(spark, FOLDER)


def order(key, status, day):
    return (key, "C1", status, at(day), at(day))


def files(path):
    return [p for p in path.rglob("*.parquet") if p.is_file()]


def test_bronze_stores_microseconds_and_declared_types(spark, tmp_path):
    lake = Lake(str(tmp_path))
    batch = spark.createDataFrame(
        [("I1", "O1", "P1", 1, Decimal("1.5"), "2026-06-01T12:34:56.123456Z")],
        "order_item_id string, order_id string, product_id string, quantity int, "
        "unit_price decimal(3,1), updated_at string",
    )
    seen = store.append_bronze(batch, lake, "order_items", run_id="r1", ingested_date=date(2026, 6, 1))
    assert seen["rows"] == 1
    (path,) = files(tmp_path / "bronze")
    assert "ingested_date=2026-06-01/run_id=r1" in str(path)
    schema = parquet.ParquetFile(path).schema_arrow
    assert schema.field("updated_at").type.unit == "us"
    assert str(schema.field("unit_price").type) == "decimal128(12, 2)"


def test_batches_with_other_inferred_types_read_together(spark, tmp_path):
    lake = Lake(str(tmp_path))
    day = date(2026, 6, 1)
    ddl = "order_item_id string, order_id string, product_id string, quantity int, unit_price {}, updated_at timestamp"
    small = spark.createDataFrame([("I1", "O1", "P1", 1, Decimal("9.5"), at(1))], ddl.format("decimal(2,1)"))
    nothing = spark.createDataFrame([("I2", "O1", "P1", 1, None, at(2))], ddl.format("int"))
    store.append_bronze(small, lake, "order_items", run_id="r1", ingested_date=day)
    store.append_bronze(nothing, lake, "order_items", run_id="r2", ingested_date=day)
    rows = store.read_bronze(spark, lake, "order_items").orderBy("order_item_id").collect()
    assert [r["unit_price"] for r in rows] == [Decimal("9.50"), None]
    assert [r["run_id"] for r in rows] == ["r1", "r2"]


def test_bronze_read_prunes_runs(spark, tmp_path):
    lake = Lake(str(tmp_path))
    for run, day in (("r1", 1), ("r2", 2)):
        batch = source(spark, "orders", [order(f"O{day}", "paid", day)])
        store.append_bronze(batch, lake, "orders", run_id=run, ingested_date=date(2026, 5, day))
    pruned = store.read_bronze(spark, lake, "orders").where("run_id = 'r2'")
    assert [r["order_id"] for r in pruned.collect()] == ["O2"]
    assert len(pruned.inputFiles()) == 2  # listed
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(run_id" in plan


def test_watermark_filter_reaches_the_scan(spark, tmp_path):
    lake = Lake(str(tmp_path))
    batch = source(spark, "orders", [order("O1", "paid", 1)])
    store.append_bronze(batch, lake, "orders", run_id="r1", ingested_date=date(2026, 5, 1))
    recent = pipeline.changed_since(store.read_bronze(spark, lake, "orders"), at(3))
    assert "GreaterThan(updated_at" in recent._jdf.queryExecution().executedPlan().toString()


def test_extraction_is_incremental_and_repeatable(spark, tmp_path):
    lake = Lake(str(tmp_path))

    def extract(rows, run):
        table = source(spark, "orders", rows)
        mark = pipeline.watermarks(spark, lake).get("orders")
        return pipeline.extract_source(spark, lake, "orders", table, run_id=run, watermark=mark)

    first = [order("O1", "paid", 1), order("O2", "paid", 2)]
    result = extract(first, "r1")
    assert (result["rows"], result["watermark_after"]) == (2, at(2))
    unchanged = extract(first, "r2")
    assert (unchanged["rows"], unchanged["output"]) == (0, None)
    assert unchanged["watermark_after"] == unchanged["watermark_before"] == at(2)
    assert len(list((tmp_path / "bronze" / "orders").rglob("run_id=*"))) == 1
    changed = extract([*first, order("O1", "shipped", 5)], "r3")
    assert (changed["rows"], changed["watermark_after"]) == (1, at(5))
    table = source(spark, "orders", first)
    pipeline.extract_source(spark, lake, "orders", table, run_id="r1")  # repeated run
    assert store.read_bronze(spark, lake, "orders").count() == 5


def test_a_repeated_run_loses_nothing(spark, tmp_path):
    """A run is repeated under its own id after its watermark has moved on."""
    lake = Lake(str(tmp_path))
    rows = [order("O1", "paid", 1), order("O2", "paid", 2)]
    for table in (rows, [*rows, order("O3", "paid", 3)]):
        mark = pipeline.watermarks(spark, lake).get("orders")
        pipeline.extract_source(
            spark, lake, "orders", source(spark, "orders", table), run_id="r1", watermark=mark
        )
    bronze = store.read_bronze(spark, lake, "orders")
    assert sorted(r["order_id"] for r in bronze.collect()) == ["O1", "O2", "O3"]
    assert pipeline.watermarks(spark, lake)["orders"] == at(3)


def test_bad_records_fail_the_read(spark, tmp_path):
    (tmp_path / "feed.json").write_text('{"event_id": "E1", "revenue": 1.0}\n{"event_id": "E2", "rev')
    with pytest.raises(Exception, match="(?i)malformed"):
        inputs.read_event_feed(spark, str(tmp_path / "feed.json")).collect()
    header = "order_item_id,order_id,product_id,quantity,unit_price,updated_at,line_amount\n"
    (tmp_path / "items.csv").write_text(header + "I1,O1,P1,many,1.00,2026-01-01T00:00:00Z,1.00\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        inputs.read_item_fixture(spark, str(tmp_path / "items.csv")).collect()


def test_unknown_sources_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="is named"):
        pipeline.extract_source(spark, Lake(str(tmp_path)), "users; --", spark.range(1), run_id="r")
    with pytest.raises(ValueError, match="is named"):
        inputs.table_options("users; --", "jdbc:any")


def test_row_store_reads_are_split_by_time():
    options = inputs.table_options(
        "orders", "jdbc:any", updated_between=(at(1), at(9)), partitions=16
    )
    assert options["dbtable"] == "orders"
    assert options["partitionColumn"] == "updated_at" and options["numPartitions"] == "16"
    assert "numPartitions" not in inputs.table_options("orders", "jdbc:any")


def test_event_feed_reads_json_lines(spark, tmp_path):
    event = {
        "event_id": "E1",
        "campaign_id": "camp",
        "channel": "email",
        "customer_id": "C1",
        "event_type": "click",
        "revenue": 0.0,
        "event_timestamp": "2026-05-01T15:00:00+07:00",
        "updated_at": "2026-05-01T08:05:00+00:00",
    }
    (tmp_path / "feed.json").write_text(json.dumps(event) + "\n")
    feed = inputs.read_event_feed(spark, str(tmp_path))
    row = feed.select(
        F.date_format("event_timestamp", "yyyy-MM-dd HH:mm").alias("t"), "revenue"
    ).first()
    assert (row["t"], row["revenue"]) == ("2026-05-01 08:00", 0.0)


def test_missing_bronze_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="orders"):
        store.read_bronze(spark, Lake(str(tmp_path)), "orders")


def test_pipeline_end_to_end(spark, tmp_path, sources):
    lake = Lake(str(tmp_path / "lake"))
    assert pipeline.status(spark, lake) == {"exists": False}
    first = pipeline.run(spark, lake, sources, salt="s", run_id="first")
    assert first["quality"]["status"] == "passed"
    assert first["transform"]["counts"]["order_items"] == ITEMS
    assert first["extract"]["total_rows"] == sum(r["rows"] for r in first["extract"]["sources"])
    assert first["warehouse"]["fact_sales_rows"] == ITEMS

    # Same data again: nothing new is extracted, the same facts are loaded.
    second = pipeline.run(spark, lake, sources, salt="s", run_id="second")
    assert second["extract"]["total_rows"] == 0
    assert second["warehouse"]["slot"] != first["warehouse"]["slot"]
    metrics = pipeline.status(spark, lake, sources)
    assert metrics["sources"] == {r["source"]: r["rows"] for r in first["extract"]["sources"]}
    assert metrics["fact_sales_rows"] == metrics["distinct_sales_keys"] == ITEMS
    assert metrics["pipeline_runs"] == 2
    columns = set(pipeline.live_warehouse(spark, lake)["dim_customer"].columns)
    assert not columns & {"full_name", "email", "phone", "address"}

    # A failed gate leaves the published layers as they were.
    live = store.live_slot(spark, lake, "silver"), store.live_slot(spark, lake, "warehouse")
    broken = dict(sources)
    broken["orders"] = sources["orders"].withColumns(
        {
            "order_status": F.lit("lost"),
            "updated_at": F.col("updated_at") + F.expr("INTERVAL 10 YEARS"),
        }
    )
    with pytest.raises(quality.QualityGateError, match="valid_business_statuses"):
        pipeline.run(spark, lake, broken, salt="s", run_id="third")
    assert live == (
        store.live_slot(spark, lake, "silver"),
        store.live_slot(spark, lake, "warehouse"),
    )
    statuses = pipeline.live_silver(spark, lake)["orders"].select("order_status").distinct()
    assert "lost" not in {r[0] for r in statuses.collect()}
    assert pipeline.status(spark, lake)["pipeline_runs"] == 2

    # The last loaded run passed, so its Silver may be published.
    target = Lake(str(tmp_path / "elsewhere"))
    published = pipeline.publish_silver(spark, lake, target)
    assert published["quality_run_id"] == "second"
    assert published["rows"]["order_items"] == ITEMS
    before = pipeline.live_silver(spark, target)
    again = pipeline.publish_silver(spark, lake, target)
    assert again["rows"] == published["rows"]
    copied = pipeline.live_silver(spark, target)
    assert {name: copied[name].count() for name in SOURCES} == published["rows"]
    assert before["orders"].count() == published["rows"]["orders"]  # a reader of the earlier copy

    # The plan counts the files that are there, and names a table without any.
    slot = store.live_slot(spark, lake, "silver")
    folder = tmp_path / "lake" / "silver"
    parts = store.load_version(spark, lake, "silver", slot).parts

    def held(name):
        return [f for b, s in parts[name].items() for f in files(folder / name / f"slot={s}" / f"bucket={b}")]

    plan = {r["table_name"]: r for r in store.publish_plan(spark, lake, slot).collect()}
    for name in SILVER_SCHEMAS:
        sizes = [path.stat().st_size for path in held(name)]
        assert (plan[name]["files"], plan[name]["bytes"]) == (len(sizes), sum(sizes))
    for path in held("payments"):
        path.unlink()
    with pytest.raises(store.PublishError, match="payments"):
        store.publish_plan(spark, lake, slot)


def test_a_load_that_is_not_published_changes_nothing(spark, tmp_path, sources, monkeypatch):
    """The driver is lost after the load, before the commit; served views outlive
    later runs."""
    lake = Lake(str(tmp_path))
    pipeline.run(spark, lake, sources, salt="s", run_id="first")
    pipeline.serve(spark, lake)
    live = store.live_publication(spark, lake, "silver"), store.live_publication(spark, lake, "warehouse")
    assert {row["run_id"] for row in live} == {"first"}

    def lost(*_, **__):
        raise ConnectionError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(store, "publish_slots", lost)
        with pytest.raises(ConnectionError):
            pipeline.run(spark, lake, sources, salt="s", run_id="second")
    assert live == (
        store.live_publication(spark, lake, "silver"),
        store.live_publication(spark, lake, "warehouse"),
    )
    assert [r["run_id"] for r in pipeline.ledger(spark, lake).collect()] == ["first"]
    for run in ("third", "fourth"):
        pipeline.run(spark, lake, sources, salt="s", run_id=run)
    assert spark.sql("SELECT count(*) FROM silver_order_items").first()[0] == ITEMS
    assert spark.sql("SELECT count(*) FROM vw_daily_sales").first()[0] > 0
    for table in spark.catalog.listTables():
        spark.catalog.dropTempView(table.name)


def test_publication_needs_a_loaded_run(spark, tmp_path):
    lake = Lake(str(tmp_path))
    with pytest.raises(store.PublishError, match="passing"):
        pipeline.publish_silver(spark, lake, Lake(str(tmp_path / "x")))


def test_lookback_reads_late_rows(spark, tmp_path):
    lake = Lake(str(tmp_path))
    table = source(spark, "orders", [order("O1", "paid", 5)])
    pipeline.extract_source(spark, lake, "orders", table, run_id="r1")
    late = source(spark, "orders", [order("O1", "paid", 5), order("O2", "paid", 4)])
    mark = pipeline.watermarks(spark, lake)["orders"]
    result = pipeline.extract_source(
        spark, lake, "orders", late, run_id="r2", watermark=mark, lookback=timedelta(days=2)
    )
    assert result["rows"] == 2
    assert result["watermark_after"] == datetime(2026, 5, 5, tzinfo=timezone.utc)


def test_acceptance(spark, tmp_path, sources):
    lake = Lake(str(tmp_path))
    fixture = spark.createDataFrame(
        [("BAD1", "ORD000000001", "PROD999999999", -2, Decimal("100.00"), at(1), Decimal("-200.00"))],
        SILVER_SCHEMAS["order_items"],
    )
    result = pipeline.acceptance(spark, lake, sources, salt="s", item_fixture=fixture)
    assert result["idempotency"]["passed"]
    assert result["bad_data_gate"] == {
        "status": "failed",
        "blocking_failures": 3,
        "warehouse_load_attempted": False,
    }
    evidence = {(r["section"], r["metric"]): r["value"] for r in result["evidence"].collect()}
    assert evidence["reconciliation", "revenue_reconciles"] == "true"
    assert evidence["quality", quality.RAW_PII_ABSENT] == "passed"
    assert evidence["privacy", "protected_columns"] == "email_hash, phone_masked"
    assert evidence["silver_rows", "order_items"] == evidence["objects", "fact_sales"] == str(ITEMS)
    assert evidence["bronze_rows", "order_items"] == "6000"
    assert evidence["bad_fixture", "blocking_failures"] == "3"

    pipeline.serve(spark, lake)
    total = spark.sql("SELECT sum(orders) FROM vw_daily_sales").first()[0]
    assert str(total) == evidence["executive", "orders"]
    assert spark.sql("SELECT count(*) FROM pipeline_runs").first()[0] == 2
    assert spark.sql("SELECT count(*) FROM silver_order_items").first()[0] == ITEMS
    for table in spark.catalog.listTables():
        spark.catalog.dropTempView(table.name)
