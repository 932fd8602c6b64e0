"""Registered queries: each operator over the whole sample tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions import utc_timestamps
from shopledger.operators import (
    SkewPolicy,
    changed_since,
    extract_manifest,
    latest_by_key,
    ordered_page,
    same_rows,
    seek_page,
)
from shopledger.plans import marts, quality, runs
from shopledger.plans.silver import changes, row_counts, silver_table, with_changes
from shopledger.plans.states import STATES
from shopledger.plans.warehouse import (
    DIMENSIONS,
    FACTS,
    affected_orders,
    dim_channel,
    dim_customer,
    dim_date,
    dim_product,
    fact_campaign_events,
    fact_sales,
    load_assertions,
    sales_of_orders,
)
from shopledger.schemas import EVENT_FEED_SCHEMA, ITEM_FIXTURE_SCHEMA, REJECTED_RECORD, SOURCE_SCHEMAS, SOURCES
from shopledger.session import bound_tasks, prepare, shared_folder
from shopledger.sources import lake as store
from shopledger.sources.inputs import parsed_events, read_item_fixture
from shopledger.sources.lake import Lake, written
from shopledger.sources.sample import campaign_events, sample_source, sample_tables
from verification.faults import faulty_silver

SALT = "sample-salt"
RUN_ID = "RUN-0001"
WATERMARKS = {
    "customers": "1995-01-20T00:00:00+00:00",
    "orders": "1998-01-01T00:00:00+00:00",
    "order_items": "1998-01-01T00:00:00+00:00",
    "payments": "1998-01-01T00:00:00+00:00",
    "campaign_events": "2024-01-15T12:00:00+00:00",
}
# Splits every key with more rows than this, whatever the table size, so that
# the split joins can be compared with the plain ones on the sample.
FORCED_SKEW = SkewPolicy(split=True, rows_per_task=3)


def portable(df: DataFrame) -> DataFrame:
    """Result types every engine has: money as double (after exact decimal
    arithmetic) and zone-free timestamps."""
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.TimestampType):
            casts[field.name] = F.col(field.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


class Layer(Mapping):
    """Tables built when first asked for: a query plans only what it reads."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]):
        self._names, self._build, self._built = tuple(names), build, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self):
        return len(self._names)


class Sample:
    """The layers over one sample folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder
        bound_tasks(spark, *sample_tables(spark, folder))
        self.sources = Layer(SOURCES, lambda name: sample_source(spark, folder, name))
        # Bronze after every source was extracted twice.
        self.replayed = Layer(SOURCES, lambda name: self.sources[name].unionByName(self.sources[name]))
        self.silver = self._silver_of(self.sources)
        self.warehouse = Layer((*DIMENSIONS, *FACTS), self._warehouse_table)
        self.marts = Layer(marts.MART_NAMES, self._mart)

    @staticmethod
    def _silver_of(bronze: Mapping[str, DataFrame]) -> Layer:
        return Layer(SOURCES, lambda name: silver_table(name, bronze[name], salt=SALT))

    def _warehouse_table(self, name: str) -> DataFrame:
        silver = self.silver
        return {
            "dim_customer": lambda: dim_customer(silver["customers"]),
            "dim_product": lambda: dim_product(silver["products"]),
            "dim_date": lambda: dim_date(silver["orders"], silver["campaign_events"]),
            "dim_channel": lambda: dim_channel(silver["campaign_events"]),
            "fact_sales": lambda: fact_sales(silver),
            "fact_campaign_events": lambda: fact_campaign_events(silver),
        }[name]()

    def _mart(self, name: str) -> DataFrame:
        w = self.warehouse
        return {
            "vw_executive_summary": lambda: marts.executive_summary(w["fact_sales"]),
            "vw_daily_sales": lambda: marts.daily_sales(w["fact_sales"], w["dim_date"]),
            "vw_product_performance": lambda: marts.product_performance(
                w["fact_sales"], w["dim_product"]
            ),
            "vw_customer_segments": lambda: marts.customer_segments(
                w["fact_sales"], w["dim_customer"]
            ),
            "vw_campaign_performance": lambda: marts.campaign_performance(
                w["fact_campaign_events"], w["dim_channel"]
            ),
        }[name]()

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        return written(self.spark, {name: df}, shared_folder(self.spark))[name]

    def kept_in_turn(self, tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
        """The tables, written one after another: the disk holds what one of them shuffles,
        not what all do."""
        return {name: self.kept(df, name) for name, df in tables.items()}

    def with_kept_payments(self) -> Sample:
        """The same layers over payments that are written once, when first read: they come
        from a sum over all items, which each job that reads them would do again."""
        sample, sources = Sample(self.spark, self.folder), self.sources
        sample.sources = Layer(
            SOURCES,
            lambda name: self.kept(sources[name], name) if name == "payments" else sources[name],
        )
        sample.silver = sample._silver_of(sample.sources)
        return sample

    def staged(self, *passing: str) -> Sample:
        """The same layers over Silver and a star schema that are written once,
        as the pipeline has them, for queries that read each fact many times. ``passing``
        tables of Silver, which only one table is made from, go into that unwritten."""
        sample = Sample(self.spark, self.folder)
        sample.sources = self.sources
        kept = {name: df for name, df in self.silver.items() if name not in passing}
        sample.silver = {**self.silver, **written(self.spark, kept, shared_folder(self.spark))}
        sample.warehouse = self.kept_in_turn(sample.warehouse)
        return sample

    @property
    def reloaded_sales(self) -> DataFrame:
        """Sales facts of a second load, from the replayed Bronze."""
        return fact_sales(self._silver_of(self.replayed))

    @property
    def reloaded_kept_sales(self) -> DataFrame:
        """The same over the Silver of that load, written table by table."""
        read = [name for name in SOURCES if name != "campaign_events"]
        replayed = self._silver_of(self.replayed)
        return fact_sales(self.kept_in_turn({name: replayed[name] for name in read}))

    @property
    def faulty(self):
        all_events = campaign_events(self.spark, self.folder, raw_types=True)
        clean = dict(self.silver)
        clean["campaign_events"] = silver_table("campaign_events", all_events, salt=SALT)
        return faulty_silver(clean)

    @property
    def daily(self) -> DataFrame:
        return self.marts["vw_daily_sales"]

    @property
    def with_bad_item(self):
        return quality.with_item_fixture(self.silver, bad_item(self.spark))

    @property
    def ledger(self) -> DataFrame:
        """A run per calendar year of order items."""
        return _yearly_runs(self.sources["order_items"], "updated_at")

    @property
    def objects(self):
        return {
            **{name: ("BASE TABLE", df) for name, df in self.warehouse.items()},
            **{name: ("VIEW", df) for name, df in self.marts.items()},
        }


class Increment:
    """The sample as it was before its last batch, and what that batch makes of it: an
    order in ten is new with its items and payments, one in three moves to another day and
    status, and the rest is read once more."""

    _OF_ORDERS = ("orders", "order_items", "payments")

    def __init__(self, sample: Sample):
        self.sample = sample = sample.with_kept_payments()
        before = {name: silver_table(name, self._earlier(name), salt=SALT) for name in SOURCES}
        self.before = sample.kept_in_turn(before)
        changed = {name: changes(name, self.before[name], sample.silver[name]) for name in SOURCES}
        self.changed = sample.kept_in_turn(changed)
        self.silver = {name: with_changes(name, self.before[name], self.changed[name]) for name in SOURCES}

    def _earlier(self, name: str) -> DataFrame:
        rows = self.sample.sources[name]
        if name not in self._OF_ORDERS:
            return rows
        number = F.substring("order_id", 4, 9).cast("int")
        rows = rows.where(number % 10 != 0)
        if name == "orders":
            moved = number % 3 == 0
            rows = rows.withColumns(
                {
                    "order_status": F.when(moved, "Pending").otherwise(F.col("order_status")),
                    "order_timestamp": F.col("order_timestamp") + F.when(moved, F.expr("INTERVAL 40 DAYS")).otherwise(F.expr("INTERVAL 0 DAYS")),
                    "updated_at": F.col("updated_at") - F.expr("INTERVAL 1 HOUR"),
                }
            )
        return rows

    def facts(self) -> tuple[DataFrame, DataFrame, DataFrame]:
        """Sales facts before, ids of the affected orders, and their facts now. Facts leave
        their joins dealt out by order, as whoever reads them wants them; so they are
        not written."""
        affected = self.sample.kept(affected_orders(self.changed), "affected")
        return fact_sales(self.before, verified=True), affected, sales_of_orders(self.silver, affected)

    def sales(self) -> DataFrame:
        before, affected, now = self.facts()
        return before.join(affected, "order_id", "left_anti").unionByName(now)

    def state(self, name: str) -> DataFrame:
        before, affected, now = self.facts()
        state, products = STATES[name], dim_product(self.before["products"])
        was = before.join(affected, "order_id", "left_semi")
        moved = state.difference(state.of(was, products), state.of(now, products))
        return state.plus(state.of(before, products), moved)

    def daily(self) -> DataFrame:
        return marts.daily_view(self.state("state_days"), self.sample.warehouse["dim_date"])

    def segments(self) -> DataFrame:
        return marts.segment_view(self.state("state_customers"), self.sample.warehouse["dim_customer"])


def _bronze_read(s: Sample) -> DataFrame:
    """Orders, appended in two runs and read back."""
    lake, orders = Lake(shared_folder(s.spark)), s.sources["orders"]
    late = F.col("updated_at") > F.lit(WATERMARKS["orders"]).cast("timestamp")
    for run, rows, day in (("r1", orders.where(~late), 1), ("r2", orders.where(late), 2)):
        store.append_bronze(rows, lake, "orders", run_id=run, ingested_date=date(2026, 1, day))
    columns = [*SOURCE_SCHEMAS["orders"].fieldNames(), "ingested_date", "run_id"]
    return store.read_bronze(s.spark, lake, "orders").select(*columns)


def _fixture_read(s: Sample) -> DataFrame:
    """Order items, written as CSV and read as a fixture."""
    path = shared_folder(s.spark)
    s.silver["order_items"].write.option("header", True).csv(path)
    return read_item_fixture(s.spark, path)


def _published_copy(s: Sample) -> DataFrame:
    """Silver as a version of one lake, copied to another: rows and likeness by table.
    Silver is built once; its fingerprint is observed while the version is written."""
    here, there = Lake(shared_folder(s.spark)), Lake(shared_folder(s.spark))
    built: dict[str, dict] = {}
    store.stage_silver(s.spark, s.silver, here, "s", prints=built)
    copied = store.read_silver(s.spark, there, store.copy_silver(s.spark, here, "s", there, "t"))
    parts = [
        same_rows(built[name], copied[name]).select(F.lit(name).alias("table_name"), "*") for name in SOURCES
    ]
    return reduce(DataFrame.unionByName, parts)


def _publish_plan(s: Sample) -> DataFrame:
    """Which tables a publication would copy, and that their files hold bytes."""
    lake = Lake(shared_folder(s.spark))
    store.stage_silver(s.spark, s.silver, lake, "s")
    plan = store.publish_plan(s.spark, lake, "s")
    return plan.select("table_name", (F.col("files") > 0).alias("has_files"), (F.col("bytes") > F.col("files")).alias("has_bytes"))


def _load_fingerprint(s: Sample) -> DataFrame:
    """Two loads of the same data, and loads with one amount changed and with a row
    doubled beside a lost one, by checksum of whole rows."""
    s = s.with_kept_payments()
    sales = written(s.spark, {"sales": s.warehouse["fact_sales"]}, shared_folder(s.spark))["sales"]
    ends = sales.agg(F.min("sales_key").alias("low"), F.max("sales_key").alias("high"))
    low, high = (ends.select(c).scalar() for c in ("low", "high"))
    at_low = F.col("sales_key") == low
    amount = F.when(at_low, F.col("gross_amount") + F.lit("0.01").cast("decimal(12,2)")).otherwise(F.col("gross_amount"))
    others = {
        "reloaded": s.reloaded_sales,
        "amount": sales.withColumn("gross_amount", amount.cast("decimal(12,2)")),
        "doubled": sales.where(~at_low).unionByName(sales.where(F.col("sales_key") == high)),
    }
    parts = [same_rows(sales, df).select(F.lit(name).alias("load"), "*") for name, df in others.items()]
    return reduce(DataFrame.unionByName, parts)


def _wire_lines(events: DataFrame) -> DataFrame:
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    times = {
        name: F.concat(F.date_format(name, iso), F.lit("+00:00"))
        for name in ("event_timestamp", "updated_at")
    }
    return events.withColumns(times).select("event_id", F.to_json(F.struct("*")).alias("value"))


def _readable_events(s: Sample) -> DataFrame:
    """The feed with every 97th line cut short: the events that can be read, each with
    the number of lines set aside."""
    lines = _wire_lines(s.sources["campaign_events"])
    cut = F.substring("event_id", 4, 9).cast("int") % 97 == 0
    events = parsed_events(lines.select(F.when(cut, F.substring("value", 1, 40)).otherwise(F.col("value")).alias("value")))
    aside = events.agg(F.count(REJECTED_RECORD)).scalar()
    return events.where(F.col(REJECTED_RECORD).isNull()).drop(REJECTED_RECORD).withColumn("set_aside", aside)


SEEK_AFTER = ("2024-01-10 00:00:00", "EVT000000000")


def _seek_page(s: Sample) -> DataFrame:
    after = (datetime.fromisoformat(SEEK_AFTER[0]).replace(tzinfo=timezone.utc), SEEK_AFTER[1])
    return seek_page(s.sources["campaign_events"], ["updated_at", "event_id"], after=after, limit=200)


def bad_item(spark: SparkSession) -> DataFrame:
    """One order item with an unknown product and negative amounts."""
    values = {
        "order_item_id": "BADITEM0001",
        "order_id": "ORD000000001",
        "product_id": "PROD999999999",
        "quantity": "-2",
        "unit_price": "100.00",
        "updated_at": "2026-06-01T00:00:00+00:00",
        "line_amount": "-200.00",
    }
    return spark.range(1).select(
        *(F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in ITEM_FIXTURE_SCHEMA.fields)
    )


def _run_of_year(column: str):
    return F.concat(F.lit("RUN-"), F.year(column).cast("string"))


def _yearly_runs(df: DataFrame, time: str) -> DataFrame:
    return df.groupBy(_run_of_year(time).alias("run_id")).agg(
        F.max(time).alias("loaded_at"),
        F.count(F.lit(1)).alias("fact_sales_rows"),
        F.lit(0).cast("bigint").alias("fact_campaign_rows"),
        F.lit("success").alias("status"),
    )


def _quality_log(items: DataFrame) -> DataFrame:
    """Two gate reports per year: one for the run itself, and a later one of a
    trial run under stricter rules, which fails."""
    run = _run_of_year("updated_at")
    good = items.groupBy(run.alias("run_id")).agg(
        F.max("updated_at").alias("checked_at"),
        F.count_if(F.col("quantity") <= 0).alias("failures"),
    )
    trial = items.groupBy(F.concat(F.lit("TRIAL-"), run).alias("run_id")).agg(
        (F.max("updated_at") + F.expr("INTERVAL 1 DAY")).alias("checked_at"),
        F.count_if(F.col("quantity") >= 50).alias("failures"),
    )
    return good.unionByName(trial).select(
        "run_id",
        "checked_at",
        F.lit(quality.POSITIVE_AMOUNTS).alias("check_name"),
        "failures",
        (F.col("failures") == 0).alias("passed"),
        F.lit(True).alias("blocking"),
        F.lit("").alias("detail"),
    )


def _json_feed(events: DataFrame) -> DataFrame:
    """The event source through its wire format: JSON text with ISO times."""
    lines = _wire_lines(events).select(F.col("value").alias("line"))
    return utc_timestamps(
        lines.select(F.from_json("line", EVENT_FEED_SCHEMA).alias("event")).select("event.*")
    )


def _offset_times(s: Sample) -> DataFrame:
    """Event times as local text with an offset, normalised to UTC."""
    local = F.concat(
        F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+07:00")
    )
    return utc_timestamps(
        s.sources["campaign_events"].select("event_id", local.alias("event_timestamp"), "updated_at")
    )


def _raw_pii(s: Sample) -> DataFrame:
    """The schema check on Silver and, to see it fail, on the raw source."""

    def judged(layer: str, df: DataFrame) -> DataFrame:
        present = quality.raw_personal_columns(df)
        return df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(layer).alias("layer"),
            F.lit(quality.RAW_PII_ABSENT).alias("check_name"),
            F.lit(len(present)).cast("bigint").alias("failures"),
            F.lit(not present).alias("passed"),
            F.lit(", ".join(present)).alias("columns_found"),
            "rows",
        )

    return judged("silver", s.silver["customers"]).unionByName(
        judged("source", s.sources["customers"])
    )


def _evidence(s: Sample) -> DataFrame:
    """The evidence, of which each report is made and written by itself, a few rows: in
    one plan, all that any of them shuffles would lie on disk until the last is done."""
    s = s.with_kept_payments().staged()
    reports = {
        "executive": s.marts["vw_executive_summary"],
        "checks": quality.check_frame(s.silver),
        "assertions": load_assertions(s.silver, s.warehouse),
        "idempotent": runs.idempotency(s.warehouse["fact_sales"], s.reloaded_kept_sales),
        "bad_fixture_checks": quality.check_frame(s.with_bad_item),
        "layers": runs.layer_row_counts(s.sources, s.silver),
        "objects": runs.object_counts(s.objects),
    }
    return runs.evidence(**s.kept_in_turn(reports), customers=s.warehouse["dim_customer"])


def _upsert(s: Sample) -> DataFrame:
    """Runs per year of orders, with the years that order items reload."""
    return runs.record_runs(_yearly_runs(s.silver["orders"], "order_timestamp"), s.ledger)


def _check(name: str) -> Callable[[Sample], DataFrame]:
    return lambda s: quality.check_frame(s.faulty, [name])


def _silver(name: str) -> Callable[[Sample], DataFrame]:
    return lambda s: s.silver[name]


def _table(name: str) -> Callable[[Sample], DataFrame]:
    return lambda s: s.warehouse[name]


def _mart(name: str) -> Callable[[Sample], DataFrame]:
    return lambda s: s.marts[name]


_QUERIES: dict[str, Callable[[Sample], DataFrame]] = {
    "extract_incremental": lambda s: changed_since(s.sources["orders"], WATERMARKS["orders"]),
    "extract_watermarks": lambda s: extract_manifest(s.sources, WATERMARKS, run_id=RUN_ID).select(
        "source", "watermark_before", "watermark_after"
    ),
    "extract_events_incremental": lambda s: changed_since(
        _json_feed(s.sources["campaign_events"]), WATERMARKS["campaign_events"]
    ),
    "extract_manifest": lambda s: extract_manifest(s.sources, WATERMARKS, run_id=RUN_ID).select(
        "run_id", "source", "rows", "total_rows"
    ),
    "bronze_utc_normalise": _offset_times,
    "events_ordered_page": lambda s: ordered_page(
        s.sources["campaign_events"], ["updated_at", "event_id"], offset=100, limit=100
    ),
    "events_seek_page": _seek_page,
    "events_readable": _readable_events,
    "bronze_append_read": _bronze_read,
    "fixture_csv_read": _fixture_read,
    "silver_published_copy": _published_copy,
    "silver_publish_plan": _publish_plan,
    "incremental_silver_orders": lambda s: Increment(s).silver["orders"],
    "incremental_silver_order_items": lambda s: Increment(s).silver["order_items"],
    "incremental_fact_sales": lambda s: Increment(s).sales(),
    "incremental_daily_sales": lambda s: Increment(s).daily(),
    "incremental_product_performance": lambda s: Increment(s).state("state_products"),
    "incremental_customer_segments": lambda s: Increment(s).segments(),
    "load_fingerprint": _load_fingerprint,
    "source_counts": lambda s: row_counts(s.sources, "source", "rows"),
    "silver_customers": _silver("customers"),
    "silver_products": _silver("products"),
    "silver_orders": _silver("orders"),
    "silver_order_items": _silver("order_items"),
    "silver_order_items_latest": lambda s: latest_by_key(
        s.sources["order_items"], ["order_item_id"], ["updated_at"]
    ),
    "silver_payments": _silver("payments"),
    "silver_campaign_events": _silver("campaign_events"),
    "silver_row_counts": lambda s: row_counts(s.silver, "dataset", "rows"),
    "check_required_keys": _check(quality.REQUIRED_KEYS),
    "check_primary_keys_unique": _check(quality.UNIQUE_KEYS),
    "check_valid_business_statuses": _check(quality.BUSINESS_STATUSES),
    "check_positive_amounts": _check(quality.POSITIVE_AMOUNTS),
    "check_referential_integrity": _check(quality.REFERENTIAL_INTEGRITY),
    "orphans_by_relationship": lambda s: quality.orphans_by_relationship(s.faulty),
    "check_payment_reconciles": _check(quality.PAYMENT_RECONCILES),
    "check_minimum_volume": lambda s: quality.check_frame(
        s.silver,
        [quality.MINIMUM_VOLUME],
        {"customers": 100, "products": 1_000_000_000, "orders": 1_000_000_000},
    ),
    "check_raw_pii_absent": _raw_pii,
    "quality_report": lambda s: quality.check_frame(s.silver),
    "quality_report_bad_fixture": lambda s: quality.check_frame(s.with_bad_item),
    "gate_verdict_bad_fixture": lambda s: quality.gate_verdict(quality.check_frame(s.with_bad_item)),
    "dim_customer": _table("dim_customer"),
    "dim_product": _table("dim_product"),
    "dim_date": _table("dim_date"),
    "dim_channel": _table("dim_channel"),
    "fact_sales": _table("fact_sales"),
    "fact_sales_hot_keys": lambda s: fact_sales(s.silver, FORCED_SKEW),
    "fact_sales_verified": lambda s: fact_sales(s.silver, verified=True),
    "fact_campaign_events": _table("fact_campaign_events"),
    "fact_campaign_events_verified": lambda s: fact_campaign_events(s.silver, verified=True),
    "fact_campaign_events_hot_keys": lambda s: fact_campaign_events(s.silver, FORCED_SKEW),
    "load_assertions": lambda s: load_assertions(s.silver, s.warehouse),
    "warehouse_metrics": lambda s: runs.warehouse_metrics(s.warehouse, s.ledger),
    "warehouse_object_counts": lambda s: runs.object_counts(s.staged("order_items", "payments").objects),
    "vw_executive_summary": _mart("vw_executive_summary"),
    "vw_daily_sales": _mart("vw_daily_sales"),
    "vw_product_performance": _mart("vw_product_performance"),
    "vw_customer_segments": _mart("vw_customer_segments"),
    "vw_product_performance_hot_keys": lambda s: marts.product_performance(
        s.warehouse["fact_sales"], s.warehouse["dim_product"], FORCED_SKEW
    ),
    "vw_campaign_performance": _mart("vw_campaign_performance"),
    "executive_from_daily": lambda s: marts.executive_from_daily(s.daily),
    "daily_sales_coverage": lambda s: marts.daily_coverage(s.daily),
    "daily_sales_first_days": lambda s: marts.first_days(s.daily),
    "run_ledger_upsert": _upsert,
    "idempotency_check": lambda s: runs.idempotency(
        s.warehouse["fact_sales"], s.reloaded_sales
    ),
    "publishable_run": lambda s: runs.publishable_run(
        s.ledger, _quality_log(s.sources["order_items"])
    ),
    "evidence_metrics": _evidence,
    "layer_row_counts": lambda s: runs.layer_row_counts(s.replayed, s.silver),
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Callable[[Sample], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: portable(build(Sample(spark, folder.rstrip("/"))))

    return {name: bind(build) for name, build in _QUERIES.items()}
