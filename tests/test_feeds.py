"""Source reads, paging by key, records set aside, and checksums of whole rows."""

from __future__ import annotations

import json
import re
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from shopledger.operators import fingerprint, same_rows, seek_page
from shopledger.plans import pipeline, quality
from shopledger.schemas import REJECTED_RECORD
from shopledger.sources import inputs, lake as store
from shopledger.sources.lake import Lake
from tests.data import at, source


def test_row_store_ranges_are_balanced_disjoint_and_complete():
    """The quantile query and the predicates, in SQL that a row store takes."""
    hours = [at(1 + i % 28, i % 24) for i in range(900)] + [at(3)] * 300 + [None] * 25
    orders = pa.table({"updated_at": pa.array(hours, type=pa.timestamp("us", tz="UTC"))})
    store_ = duckdb.connect()
    store_.execute("SET TimeZone = 'UTC'")
    store_.register("orders", orders)

    def asked(sql):
        return store_.execute(sql).fetchone()

    cuts = asked(inputs.quantile_query("orders", 8))
    ranges = inputs.time_ranges(cuts)
    met = " + ".join(f"CASE WHEN {p} THEN 1 ELSE 0 END" for p in ranges)
    assert asked(f"SELECT min({met}), max({met}) FROM orders") == (1, 1)
    counts = [asked(f"SELECT count(*) FROM orders WHERE {p}")[0] for p in ranges]
    assert sum(counts) == len(hours) and counts[-1] == 25 and len(ranges) >= 7
    # A moment that many rows share cannot be cut.
    assert max(counts[:-1]) <= 300 + 2 * 1200 / 8
    assert min(asked(inputs.quantile_query("orders", 4, since=at(20)))) > at(20)
    assert inputs.time_ranges([None, None]) == ["updated_at IS NOT NULL", "updated_at IS NULL"]
    with pytest.raises(ValueError, match="is named"):
        inputs.quantile_query("users; --")


def test_the_default_read_asks_for_ranges(monkeypatch):
    """What reaches the JDBC reader, without a database."""
    asked = {}

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            asked["first"] = options
            return self

        def load(self):
            return self

        def first(self):
            return [at(i) for i in range(1, 16)]

        def jdbc(self, url, table, *, predicates, properties):
            asked["second"] = (url, table, predicates, properties)
            return "rows"

    class Session:
        read = Reader()

    assert inputs.read_source_table(Session(), "orders", "jdbc:any", since=at(1)) == "rows"
    assert "percentile_disc" in asked["first"]["query"] and "dbtable" not in asked["first"]
    url, table, predicates, settings = asked["second"]
    assert (url, table, len(predicates)) == ("jdbc:any", "orders", 17) and settings["fetchsize"] == "10000"


def events(spark, n=230):
    rows = [(f"E{i:04d}", "c", "web", "C1", "click", 1.0, at(1), None if i % 50 == 7 else at(1 + i % 5, i % 3)) for i in range(n)]
    return source(spark, "campaign_events", rows)


def test_all_pages_by_seeking_are_the_ordered_table(spark):
    df, order = events(spark).repartition(4), ["updated_at", "event_id"]
    whole = [tuple(r) for r in df.orderBy(*order).collect()]
    seen, after = [], None
    while True:
        page = seek_page(df, order, after=after, limit=50).collect()
        seen += [tuple(r)[:-1] for r in page]
        if not page or not page[-1]["has_more"]:
            break
        after = (page[-1]["updated_at"], page[-1]["event_id"])
    assert seen == whole
    assert seek_page(df, order, after=(at(28), "Z")).count() == 0
    with pytest.raises(ValueError, match="limit"):
        seek_page(df, order, limit=0)
    with pytest.raises(ValueError, match="each column"):
        seek_page(df, order, after=("x",))


def test_a_page_keeps_its_own_rows_and_skips_earlier_files(spark, tmp_path):
    events(spark).sortWithinPartitions("updated_at").write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    plan = seek_page(feed, ["updated_at", "event_id"], after=(at(4), "E0100"), limit=10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=11" in plan
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(updated_at,2026-05-04", plan)


GOOD = {
    "event_id": "E1", "campaign_id": "camp", "channel": "email", "customer_id": "C1", "event_type": "click", "revenue": 0.0,
    "event_timestamp": "2026-05-01T15:00:00+07:00", "updated_at": "2026-05-01T08:05:00+00:00",
}
BAD = [
    '{"event_id": "E2", "rev',
    json.dumps({**GOOD, "event_id": "E3", "revenue": "lots"}),
    json.dumps({**GOOD, "event_id": "E4", "updated_at": "soon"}),
    json.dumps({**GOOD, "event_id": None}),
    json.dumps({**GOOD, "event_id": "E5", "updated_at": None}),
    "[]",
]


def test_bad_lines_are_set_aside_and_good_ones_load(spark, tmp_path):
    lake, feed = Lake(str(tmp_path / "lake")), tmp_path / "feed"
    feed.mkdir()
    (feed / "a.json").write_text("\n".join([json.dumps(GOOD), *BAD, "", json.dumps({**GOOD, "event_id": "E9"})]) + "\n")

    def extract(run):
        table = inputs.read_event_feed(spark, str(feed), keep_rejected=True)
        mark = pipeline.watermarks(spark, lake).get("campaign_events")
        return pipeline.extract_source(spark, lake, "campaign_events", table, run_id=run, watermark=mark)

    first = extract("r1")
    assert (first["rows"], first["rejected"]) == (2, len(BAD))
    bronze = store.read_bronze(spark, lake, "campaign_events")
    assert sorted(r["event_id"] for r in bronze.collect()) == ["E1", "E9"]
    assert REJECTED_RECORD not in bronze.columns
    aside = store.read_rejected(spark, lake, "campaign_events")
    assert sorted(r[REJECTED_RECORD] for r in aside.collect()) == sorted(BAD)
    assert {r["run_id"] for r in aside.collect()} == {"r1"}
    assert "PartitionFilters: [isnotnull(batch" in bronze._jdf.queryExecution().executedPlan().toString()
    # The batch that a merge reads has the good rows alone.
    (folder,) = pipeline.complete_batches(spark, lake).values()
    assert store.read_batches(spark, lake, "campaign_events", [folder]).count() == 2
    # Read again, the same lines are known; a new one is not.
    again = extract("r2")
    assert (again["rows"], again["rejected"]) == (0, 0)
    (feed / "b.json").write_text("nonsense\n")
    assert extract("r3")["rejected"] == 1
    assert store.read_rejected(spark, lake, "campaign_events").count() == len(BAD) + 1
    assert store.read_rejected(spark, lake, "orders").count() == 0


def test_rejected_records_stop_a_run_unless_allowed():
    report = quality.gate_report("r", [{"check_name": "x", "passed": True, "blocking": True}])
    report["checked_at"] = datetime(2026, 1, 1)
    strict = quality.with_rejected(report, 2, 0)
    assert strict["failed"] == [quality.RECORDS_READABLE] and strict["checked_at"] == report["checked_at"]
    with pytest.raises(quality.QualityGateError, match=quality.RECORDS_READABLE):
        quality.require_passed(strict)
    allowed = quality.with_rejected(report, 2, 2)
    assert allowed["status"] == "passed" and allowed["checks"][-1]["detail"].startswith("2 records")


def test_fingerprint_sees_every_change_but_order(spark):
    rows = [("a", None, Decimal("1.00")), (None, "a", Decimal("1.00")), ("b", "c", None), ("b", "c", None)]
    df = spark.createDataFrame(rows, "x string, y string, z decimal(12,2)")

    def same(other):
        return same_rows(df, other).first()["same"]

    assert same(df.repartition(3).orderBy("z").select("z", "x", "y"))
    assert not same(df.withColumn("z", F.when(F.col("x") == "a", F.lit("1.01").cast("decimal(12,2)")).otherwise(F.col("z"))))
    # A row doubled beside a lost one, and values that change places with nulls.
    assert not same(spark.createDataFrame([rows[0], rows[0], *rows[2:]], df.schema))
    assert not same(spark.createDataFrame([rows[1], rows[1], *rows[2:]], df.schema))
    assert not same(df.union(df))
    empty = fingerprint(df.limit(0)).first()
    assert (empty["rows"], empty["first_sum"]) == (0, 0) and not same(df.limit(0))
    plan = same_rows(df, df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan


def test_a_version_is_built_once_and_copied_without_a_shuffle(spark, tmp_path):
    """the fingerprint is taken while Silver is written, and files of one bucket each
    are copied as they lie, unless the other lake has other buckets."""
    from tests.data import silver

    tables, prints, plans = silver(spark), {}, {}
    lake = Lake(str(tmp_path / "a"), buckets=2)
    store.stage_silver(spark, tables, lake, "s", prints=prints)
    assert prints == {name: fingerprint(df).first().asDict() for name, df in tables.items()}
    for buckets in (2, 3):
        target = Lake(str(tmp_path / f"b{buckets}"), buckets=buckets)
        with pytest.MonkeyPatch.context() as patch:
            parquet = DataFrameWriter.parquet

            def seen(self, path, *args, **kwargs):
                plans[buckets] = self._df._jdf.queryExecution().optimizedPlan().toString()
                return parquet(self, path, *args, **kwargs)

            patch.setattr(DataFrameWriter, "parquet", seen)
            patch.setattr(store.Version, "save", lambda *args: None)
            copied = store.read_silver(spark, target, store.copy_silver(spark, lake, "s", target, "t"))
        for name, df in tables.items():
            assert same_rows(prints[name], copied[name]).first().asDict() == same_rows(df, copied[name]).first().asDict()
            assert same_rows(prints[name], copied[name]).first()["same"]
    assert not same_rows(prints["orders"], tables["orders"].limit(1)).first()["same"]
    assert "Rebalance" not in plans[2] and "Rebalance" in plans[3]


def test_a_copy_that_lost_a_row_is_not_published(spark, tmp_path, monkeypatch):
    lake, target = Lake(str(tmp_path / "a"), buckets=2), Lake(str(tmp_path / "b"), buckets=2)
    from tests.data import silver

    store.stage_silver(spark, silver(spark), lake, "s")
    assert store.copy_silver(spark, lake, "s", target, "t").measures["orders"]["rows"] == 3
    whole = store.read_silver

    def spoiled(spark, at, version):
        tables = whole(spark, at, version)
        if at is target:
            tables["payments"] = tables["payments"].withColumn("payment_amount", F.col("payment_amount") + 1)
        return tables

    monkeypatch.setattr(store, "read_silver", spoiled)
    with pytest.raises(store.PublishError, match="payments"):
        store.copy_silver(spark, lake, "s", target, "u")
    assert store.append_bronze(source(spark, "orders", []), lake, "orders", run_id="r", ingested_date=date(2026, 1, 1))["rows"] == 0
