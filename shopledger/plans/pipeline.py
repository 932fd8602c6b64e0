"""Extract, Silver, gate, load: each layer is written, judged, then published.

After the first run, a run does work in proportion to what changed: new batches are
merged into the Silver buckets they touch, the sales of affected orders are rebuilt on
the days they lie or lay on, and mart states move by the difference.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions import date_key
from shopledger.operators import SkewPolicy, changed_since, same_rows
from shopledger.plans import marts, quality, runs
from shopledger.plans.silver import (
    Silver,
    build_silver,
    changes,
    changes_schema,
    row_counts,
    shaped,
    silver_table,
    with_changes,
)
from shopledger.plans.states import STATES, activity, dim_channel, dim_date, marts_of
from shopledger.plans.warehouse import (
    DIMENSIONS,
    FACTS,
    Warehouse,
    affected_days,
    affected_orders,
    dim_customer,
    dim_product,
    fact_campaign_events,
    fact_sales,
    load_assertions,
    require_loaded,
    sales_of_orders,
)
from shopledger.schemas import (
    EPOCH_WATERMARK,
    MINIMUM_ROWS,
    PRIMARY_KEYS,
    QUALITY_LOG_SCHEMA,
    RAW_PERSONAL_COLUMNS,
    REJECTED_RECORD,
    SOURCES,
    WATERMARK_SCHEMA,
)
from shopledger.session import sized_shuffles
from shopledger.sources import lake as store
from shopledger.sources.lake import Lake
from shopledger.sources.parts import BUCKET, PartTable, Version, bucket_of


def _now() -> datetime:
    return datetime.now(timezone.utc)


def new_run_id() -> str:
    return _now().strftime("%Y%m%dT%H%M%S%fZ")


def _watermark_log(spark: SparkSession, lake: Lake) -> DataFrame:
    """Each source logs to its own partition folder."""
    schema = T.StructType([*WATERMARK_SCHEMA.fields, T.StructField("source", T.StringType())])
    return store.read_log(spark, lake, "watermarks", schema)


def complete_batches(spark: SparkSession, lake: Lake) -> dict[tuple[str, str], str]:
    """Folder of every batch, by source and batch id, whose extraction was logged. A
    batch that an extraction left unfinished is not: its rows are extracted again."""
    rows = _watermark_log(spark, lake).select("source", "batch", "run_id", "ingested_date").collect()
    return {
        (r["source"], r["batch"]): f"ingested_date={r['ingested_date']}/run_id={r['run_id']}/batch={r['batch']}"
        for r in rows
    }


def watermarks(spark: SparkSession, lake: Lake) -> dict[str, datetime]:
    """Current watermark of each source; at most one row per source."""
    log = _watermark_log(spark, lake)
    rows = log.groupBy("source").agg(F.max("watermark").alias("watermark")).collect()
    return {row["source"]: row["watermark"].astimezone(timezone.utc) for row in rows}


def extract_source(
    spark: SparkSession,
    lake: Lake,
    source: str,
    table: DataFrame,
    *,
    run_id: str,
    watermark: datetime | None = None,
    lookback: timedelta = timedelta(0),
) -> dict:
    """Append the changed rows of one source to Bronze. The watermark is logged
    after the batch is written, so a lost run is read again, never skipped."""
    if source not in SOURCES:
        raise ValueError(f"No source is named {source!r}")
    before = watermark or datetime.fromisoformat(EPOCH_WATERMARK)
    batch = changed_since(table, before, lookback=lookback)
    if REJECTED_RECORD in batch.columns:
        # Records that an earlier run set aside are there already.
        known = store.read_rejected(spark, lake, source).select(REJECTED_RECORD)
        batch = batch.join(known, REJECTED_RECORD, "left_anti")
    today, batch_id = _now().date(), store.new_slot(source)
    seen = store.append_bronze(
        batch, lake, source, run_id=run_id, ingested_date=today, batch_id=batch_id
    )
    after = before
    if seen["rows"]:
        after = max(before, seen["newest"].astimezone(timezone.utc))
        store.append_log(
            spark,
            lake,
            f"watermarks/source={source}",
            [{"watermark": after, "run_id": run_id, "ingested_date": today, "batch": batch_id, "rejected": seen["rejected"]}],
            WATERMARK_SCHEMA,
        )
    return {
        "source": source,
        "rows": seen["rows"],
        "rejected": seen["rejected"],
        "watermark_before": before,
        "watermark_after": after,
        "output": lake.bronze(source) if seen["rows"] else None,
    }


def extract_all(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, DataFrame],
    *,
    run_id: str,
    lookback: timedelta = timedelta(0),
) -> dict:
    """Extract all six sources under one run id; the manifest of the run."""
    started = _now()
    known = watermarks(spark, lake)

    def extract(source: str) -> dict:
        return extract_source(
            spark,
            lake,
            source,
            sources[source],
            run_id=run_id,
            watermark=known.get(source),
            lookback=lookback,
        )

    results = store.in_parallel(spark, extract, SOURCES)
    return {
        "run_id": run_id,
        "started_at": started,
        "sources": results,
        "total_rows": sum(result["rows"] for result in results),
        "rejected": sum(result["rejected"] for result in results),
    }


def _values(spark: SparkSession, df: DataFrame) -> list[int]:
    """The values of a column that has at most as many as a table has parts."""
    return sorted(row[0] for row in df.distinct().collect())


def merge_table(
    spark: SparkSession, lake: Lake, name: str, base: Version, slot: str, incoming: DataFrame, keys: DataFrame
) -> tuple[list[int], list[int], dict[str, int]]:
    """Merge the latest ``incoming`` rows of a Silver table into the buckets of ``base``
    that they touch; the parts replaced and written, and the table's measures then.
    ``keys`` holds at least the keys of ``incoming``."""
    table, key = lake.silver(name), PRIMARY_KEYS[name]
    bucket = bucket_of(key, base.buckets)
    current = base.read(spark, table, _values(spark, keys.select(bucket)))
    moves = [c.alias(m) for m, c in quality.changed_measures(name).items()]
    seen = store.write_table(changes(name, current, incoming), lake.changes(name, slot), *moves)
    changed = read_changes(spark, lake, name, slot)
    moved = _values(spark, changed.select(f"now.{key}").select(bucket))
    if moved:
        current = base.read(spark, table, moved)
        table.write(with_changes(name, current, changed).withColumn(BUCKET, bucket), slot)
    measures = {
        m: n + seen["rows_added" if m == "rows" else m] for m, n in base.measures[name].items()
    }
    return moved, table.written(spark, slot) if moved else [], measures


def read_changes(spark: SparkSession, lake: Lake, name: str, slot: str) -> DataFrame:
    return spark.read.schema(changes_schema(name)).parquet(lake.changes(name, slot))


def merge_silver(
    spark: SparkSession, lake: Lake, base: Version, slot: str, *, batches: Mapping[tuple[str, str], str], salt: str
) -> Version:
    """Silver after new batches (folders by source and batch id), as the last version
    with the buckets they touch replaced. Equal to a rebuild from all batches, since
    the latest of the latest is the latest."""
    new = {key: folder for key, folder in batches.items() if key not in base.batches}
    sources = [source for source in SOURCES if any(s == source for s, _ in new)]

    def merge(name: str) -> tuple:
        batch = store.read_batches(spark, lake, name, [f for (s, _), f in sorted(new.items()) if s == name])
        keys = shaped(name, batch, salt=salt).select(PRIMARY_KEYS[name])
        return merge_table(spark, lake, name, base, slot, silver_table(name, batch, salt=salt), keys)

    version = base.carried(slot, base.slot)
    for name, (replaced, written, measures) in zip(sources, store.in_parallel(spark, merge, sources)):
        version = version.with_parts(name, replaced, written).with_measures(name, measures)
    version = replace(version, batches=base.batches | set(new), changed=frozenset(sources))
    version.save(spark, lake.version("silver", slot))
    return version


def transform(
    spark: SparkSession, lake: Lake, slot: str, *, salt: str, run_id: str, rebuild: bool = False
) -> dict:
    """Silver of all Bronze batches as a version in a slot: what is live with the
    batches that came since merged in, or, at first or to ``rebuild``, all made anew."""
    base = None if rebuild else store.live_version(spark, lake, "silver")
    batches = complete_batches(spark, lake)
    if base is None:
        bronze = {source: store.read_bronze(spark, lake, source) for source in SOURCES}
        with sized_shuffles(spark, *bronze.values()):
            version = store.stage_silver(
                spark, build_silver(bronze, salt=salt), lake, slot, batches=batches, measures=quality.written_measures
            )
    else:
        with sized_shuffles(spark, *store.read_silver(spark, lake, base).values()):
            version = merge_silver(spark, lake, base, slot, batches=batches, salt=salt)
    return {
        "run_id": run_id,
        "completed_at": _now(),
        "counts": {name: found["rows"] for name, found in version.measures.items()},
        "merged_batches": len(version.batches) - len(base.batches if base else ()),
        "pii_removed_from_silver": list(RAW_PERSONAL_COLUMNS),
    }


def gate(
    spark: SparkSession,
    lake: Lake,
    silver: Silver,
    *,
    run_id: str,
    item_fixture: DataFrame | None = None,
    minimum_rows: Mapping[str, int] = MINIMUM_ROWS,
    policy: SkewPolicy = SkewPolicy(),
    raise_on_failure: bool = True,
    measures: Mapping[str, Mapping[str, int]] | None = None,
    rejected: int = 0,
    most_rejected: int = 0,
) -> dict:
    """Run the gate and log its check rows, then raise if it failed. ``measures`` are
    those of the Silver version, observed while it was written. The run has set aside
    ``rejected`` source records; more than ``most_rejected`` fail it."""
    with sized_shuffles(spark, *silver.values()):
        report = quality.run_gate(
            silver,
            run_id=run_id,
            item_fixture=item_fixture,
            minimum_rows=minimum_rows,
            policy=policy,
            raise_on_failure=False,
            measures=measures,
        )
    if rejected:
        report = quality.with_rejected(report, rejected, most_rejected)
    rows = [
        {"run_id": run_id, "checked_at": report["checked_at"], **check}
        for check in report["checks"]
    ]
    store.append_log(spark, lake, "quality", rows, QUALITY_LOG_SCHEMA)
    if raise_on_failure:
        quality.require_passed(report)
    return report


def _object(lake: Lake, name: str) -> PartTable:
    return lake.warehouse(name, STATES[name].schema if name in STATES else None)


def read_warehouse(spark: SparkSession, lake: Lake, slot: str | Version) -> Warehouse:
    """Dimensions, facts and mart states of a version."""
    version = slot if isinstance(slot, Version) else store.load_version(spark, lake, "warehouse", slot)
    return {name: version.read(spark, _object(lake, name)) for name in (*DIMENSIONS, *FACTS, *STATES)}


class _Loading:
    """A warehouse version in the making."""

    def __init__(self, spark: SparkSession, lake: Lake, version: Version) -> None:
        self.spark, self.lake, self.version = spark, lake, version

    def table(self, name: str, version: Version | None = None) -> DataFrame:
        return (version or self.version).read(self.spark, _object(self.lake, name))

    def put(self, name: str, df: DataFrame, replaced: list[int]) -> list[int]:
        """Write parts of a table; the parts that came out. ``replaced`` ones go."""
        at = _object(self.lake, name)
        at.write(df, self.version.slot)
        return at.written(self.spark, self.version.slot)

    def put_all(self, tables: Mapping[str, tuple[DataFrame, list[int]]]) -> None:
        names = list(tables)
        done = store.in_parallel(self.spark, lambda name: self.put(name, *tables[name]), names)
        for name, written in zip(names, done):
            self.version = self.version.with_parts(name, tables[name][1], written)

    def bucketed(self, name: str, df: DataFrame, key: str) -> DataFrame:
        return df.withColumn(BUCKET, bucket_of(key, self.version.buckets))

    def calendar(self, states: Mapping[str, DataFrame]) -> None:
        """Dates and channels, a few thousand rows in one part."""
        found = {"dim_date": dim_date(states), "dim_channel": dim_channel(states)}
        self.put_all({n: (df.withColumn(BUCKET, F.lit(0)), [0]) for n, df in found.items()})

    def states(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in STATES}


def _load_all(load: _Loading, silver: Silver, policy: SkewPolicy, verified: bool) -> None:
    """Every table from all of Silver."""
    products = load.bucketed("dim_product", dim_product(silver["products"]), "product_id")
    load.put_all(
        {
            "dim_customer": (load.bucketed("dim_customer", dim_customer(silver["customers"]), "customer_id"), []),
            "dim_product": (products, []),
            "fact_sales": (fact_sales(silver, policy, verified=verified), []),
            "fact_campaign_events": (fact_campaign_events(silver, policy, verified=verified), []),
        }
    )
    rows = {
        "fact_sales": load.table("fact_sales"),
        "fact_campaign_events": load.table("fact_campaign_events"),
        "activity": activity(silver["orders"], silver["campaign_events"]),
        "channels": silver["campaign_events"],
    }
    products = load.table("dim_product")
    load.put_all(
        {
            name: (load.bucketed(name, state.of(rows[state.base], products), list(state.keys)), [])
            for name, state in STATES.items()
        }
    )
    load.calendar(load.states())


def _load_changes(load: _Loading, silver: Silver, merged: Version) -> None:
    """Bring a version up to a Silver that was merged from the one it was loaded from.
    That Silver has passed the gate: every key is known and unique."""
    spark, lake, before = load.spark, load.lake, load.version
    changed = {
        name: read_changes(spark, lake, name, merged.slot)
        if name in merged.changed
        else spark.createDataFrame([], changes_schema(name))
        for name in SOURCES
    }
    # Buckets of a dimension are those of its Silver table.
    puts = {}
    for dim, name, make in (("dim_customer", "customers", dim_customer), ("dim_product", "products", dim_product)):
        key = PRIMARY_KEYS[name]
        moved = _values(spark, changed[name].select(f"now.{key}").select(bucket_of(key, merged.buckets)))
        if moved:
            rows = merged.read(spark, lake.silver(name), moved)
            puts[dim] = (load.bucketed(dim, make(rows), key), moved)

    ids = lake.changes("affected_orders", load.version.slot)
    store.write_table(affected_orders(changed), ids)
    affected = spark.read.schema("order_id string").parquet(ids)
    days = _values(spark, affected_days(silver["orders"], affected, changed["orders"]))
    old_sales = before.read(spark, _object(lake, "fact_sales"), days)
    if days:
        sales = old_sales.join(affected, "order_id", "left_anti").unionByName(sales_of_orders(silver, affected))
        puts["fact_sales"] = (sales, days)

    events = changed["campaign_events"]
    event_ids = events.select("now.event_id")
    times = events.select("now.event_timestamp").union(events.select("was.event_timestamp"))
    event_days = _values(spark, times.select(date_key(F.to_date("event_timestamp"))).na.drop())
    old_events = before.read(spark, _object(lake, "fact_campaign_events"), event_days)
    if event_days:
        now = fact_campaign_events({**silver, "campaign_events": events.select("now.*")}, verified=True)
        puts["fact_campaign_events"] = (old_events.join(event_ids, "event_id", "left_anti").unionByName(now), event_days)
    load.put_all(puts)

    def of_days(name: str, days: list[int]) -> DataFrame:
        return load.version.read(spark, _object(lake, name), days)

    def silver_rows(name: str, side: str) -> DataFrame:
        return changed[name].where(F.col(side).isNotNull()).select(f"{side}.*")

    sides = {
        side: {
            "fact_sales": sales.join(affected, "order_id", "left_semi"),
            "fact_campaign_events": facts.join(event_ids, "event_id", "left_semi"),
            "activity": activity(silver_rows("orders", side), silver_rows("campaign_events", side)),
            "channels": silver_rows("campaign_events", side),
        }
        for side, sales, facts in (
            ("was", old_sales, old_events),
            ("now", of_days("fact_sales", days), of_days("fact_campaign_events", event_days)),
        )
    }
    products = {"was": load.table("dim_product", before), "now": load.table("dim_product")}
    named = ("category", "product_name")
    renamed = not changed["products"].where(
        F.col("was").isNotNull() & ~F.struct(*(f"was.{c}" for c in named)).eqNullSafe(F.struct(*(f"now.{c}" for c in named)))
    ).isEmpty()

    def move(name: str) -> tuple[DataFrame, list[int]] | None:
        state = STATES[name]
        if renamed and name == "state_products":
            # Orders that did not change moved to another name: all facts count anew.
            whole = state.of(load.table("fact_sales"), products["now"])
            return load.bucketed(name, whole, list(state.keys)), list(before.parts.get(name, {}))
        was, now = (state.of(sides[side][state.base], products[side]) for side in ("was", "now"))
        path = lake.changes(name, load.version.slot)
        store.write_table(state.difference(was, now), path)
        difference = spark.read.schema(state.schema).parquet(path)
        touched = _values(spark, difference.select(bucket_of(list(state.keys), load.version.buckets)))
        if not touched:
            return None
        held = before.read(spark, _object(lake, name), touched)
        return load.bucketed(name, state.plus(held, difference), list(state.keys)), touched

    names = list(STATES)
    moves = dict(zip(names, store.in_parallel(spark, move, names)))
    load.put_all({name: found for name, found in moves.items() if found})
    load.calendar(load.states())


def load(
    spark: SparkSession,
    lake: Lake,
    silver: Silver,
    *,
    run_id: str,
    policy: SkewPolicy = SkewPolicy(),
    verified: bool = False,
    silver_slot: str | None = None,
    base: int | None = None,
) -> dict:
    """Build the star schema as a version in a slot of its own, assert on what was
    written, then publish it and record the run. ``verified`` if the gate has passed
    this very Silver; ``silver_slot`` if that is to go live in the same commit; ``base`` is
    the publication that the run builds on (by default the newest).

    If verified Silver was merged from the one that the live warehouse was loaded
    from, only what the merge changed is loaded, else everything."""
    base = store.newest_number(spark, lake) if base is None else base
    slot = store.new_slot(run_id)
    live = store.live_version(spark, lake, "warehouse")
    merged = store.load_version(spark, lake, "silver", silver_slot) if silver_slot else None
    follows = bool(verified and merged and live and merged.origin and merged.origin == live.origin)
    version = live.carried(slot, silver_slot) if follows else Version(slot, lake.buckets, silver_slot)
    loading = _Loading(spark, lake, version)
    with sized_shuffles(spark, *silver.values()):
        if follows:
            _load_changes(loading, silver, merged)
        else:
            _load_all(loading, silver, policy, verified)
        loading.version.save(spark, lake.version("warehouse", slot))
        metrics = load_assertions(silver, read_warehouse(spark, lake, loading.version)).first().asDict()
    require_loaded(metrics)
    loaded_at = _now()
    slots = {"warehouse": slot} if silver_slot is None else {"silver": silver_slot, "warehouse": slot}
    number = store.publish_slots(spark, lake, slots, run_id=run_id, at=loaded_at, base=base, loaded=metrics)
    return {"run_id": run_id, "loaded_at": loaded_at, "slot": slot, "publication": number, "incremental": follows, **metrics}


def ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per loaded run, from the publications of the warehouse."""
    loads = store.publications(spark, lake).where(F.col("layer") == "warehouse").select(
        "run_id",
        F.col("published_at").alias("loaded_at"),
        "fact_sales_rows",
        "fact_campaign_rows",
        F.lit("success").alias("status"),
    )
    return runs.current_runs(loads)


def live_silver(spark: SparkSession, lake: Lake) -> Silver:
    slot = store.live_slot(spark, lake, "silver")
    if slot is None:
        raise FileNotFoundError(f"No published Silver in {lake.root}")
    return store.read_silver(spark, lake, slot)


def live_warehouse(spark: SparkSession, lake: Lake) -> Warehouse:
    slot = store.live_slot(spark, lake, "warehouse")
    if slot is None:
        raise FileNotFoundError(f"No published warehouse in {lake.root}")
    return read_warehouse(spark, lake, slot)


def run(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, DataFrame],
    *,
    salt: str,
    run_id: str | None = None,
    minimum_rows: Mapping[str, int] = MINIMUM_ROWS,
    lookback: timedelta = timedelta(0),
    policy: SkewPolicy = SkewPolicy(),
    rebuild: bool = False,
    most_rejected: int = 0,
) -> dict:
    """The whole pipeline. A failed gate or load assertion raises and leaves the
    live Silver and warehouse untouched, and so does another run that publishes first:
    then this one raises, and its batches are merged by the next. ``rebuild`` makes
    Silver and warehouse anew from all batches. More than ``most_rejected`` records set
    aside stop the run; those that could be read are then loaded by the next."""
    run_id = run_id or new_run_id()
    base = store.newest_number(spark, lake)
    extraction = extract_all(spark, lake, sources, run_id=run_id, lookback=lookback)
    slot = store.new_slot(run_id)
    transformation = transform(spark, lake, slot, salt=salt, run_id=run_id, rebuild=rebuild)
    version = store.load_version(spark, lake, "silver", slot)
    silver = store.read_silver(spark, lake, version)
    report = gate(
        spark,
        lake,
        silver,
        run_id=run_id,
        minimum_rows=minimum_rows,
        policy=policy,
        measures=version.measures,
        rejected=extraction["rejected"],
        most_rejected=most_rejected,
    )
    # The gate above raised unless every key of this Silver is known and unique.
    warehouse = load(
        spark, lake, silver, run_id=run_id, policy=policy, verified=True, silver_slot=slot, base=base
    )
    return {
        "run_id": run_id,
        "extract": extraction,
        "transform": transformation,
        "quality": report,
        "warehouse": warehouse,
    }


def publish_silver(spark: SparkSession, lake: Lake, target: Lake) -> dict:
    """Copy live Silver to another lake and make it live there, if the last loaded
    run passed its gate."""
    log = store.read_log(spark, lake, "quality", QUALITY_LOG_SCHEMA)
    allowed = runs.publishable_run(ledger(spark, lake), log).first()
    if allowed is None:
        raise store.PublishError("The last loaded run has no passing quality report.")
    live = store.live_publication(spark, lake, "silver")
    if live is None or live["run_id"] != allowed["run_id"]:
        raise store.PublishError(f"Silver of run {allowed['run_id']} is not the published one.")
    slot = store.new_slot(live["run_id"])
    base = store.newest_number(spark, target)
    copied = store.copy_silver(spark, lake, live["slot"], target, slot)
    counts = {name: found["rows"] for name, found in copied.measures.items()}
    store.publish_slots(spark, target, {"silver": slot}, run_id=live["run_id"], at=_now(), base=base)
    return {"quality_run_id": allowed["run_id"], "rows": counts}


def status(
    spark: SparkSession, lake: Lake, sources: Mapping[str, DataFrame] | None = None
) -> dict:
    """Metrics of the live warehouse and, if asked, the rows of each source."""
    report: dict = {"exists": False}
    if store.live_slot(spark, lake, "warehouse") is not None:
        metrics = runs.warehouse_metrics(live_warehouse(spark, lake), ledger(spark, lake))
        report = {"exists": True, **metrics.first().asDict()}
    if sources is not None:
        counts = row_counts(sources, "source", "rows").collect()
        report["sources"] = {row["source"]: row["rows"] for row in counts}
    return report


def serve(spark: SparkSession, lake: Lake) -> None:
    """Register the live tables, the ledger and the serving views for ``spark.sql``."""
    for name, df in live_silver(spark, lake).items():
        df.createOrReplaceTempView(f"silver_{name}")
    ledger(spark, lake).createOrReplaceTempView("pipeline_runs")
    warehouse = live_warehouse(spark, lake)
    for name, df in {**warehouse, **state_marts(warehouse)}.items():
        df.createOrReplaceTempView(name)


def state_marts(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The five marts of a loaded warehouse, from its states."""
    return marts_of(warehouse, warehouse["dim_customer"])


def acceptance(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, DataFrame],
    *,
    salt: str,
    item_fixture: DataFrame,
    minimum_rows: Mapping[str, int] = MINIMUM_ROWS,
) -> dict:
    """Run twice, compare the two loads, show that the fixture is stopped, and
    return the reports with the evidence frame."""
    options = {"salt": salt, "minimum_rows": minimum_rows}
    first = run(spark, lake, sources, run_id=f"{new_run_id()}-first", **options)
    first_sales = live_warehouse(spark, lake)["fact_sales"]
    second = run(spark, lake, sources, run_id=f"{new_run_id()}-second", **options)
    # Each load has a slot of its own, so both are there to compare.
    warehouse, silver = live_warehouse(spark, lake), live_silver(spark, lake)
    compared = runs.idempotency(first_sales, warehouse["fact_sales"])
    idempotency = compared.first().asDict()
    content = same_rows(first_sales, warehouse["fact_sales"]).first()
    if not (idempotency["passed"] and content["same"]):
        raise RuntimeError(f"A second run changed the sales facts: {idempotency}, {content}")

    bad_run = f"{new_run_id()}-bad-fixture"
    bad = gate(
        spark,
        lake,
        silver,
        run_id=bad_run,
        item_fixture=item_fixture,
        minimum_rows=minimum_rows,
        raise_on_failure=False,
    )
    if bad["status"] != "failed":
        raise RuntimeError("The bad fixture passed the quality gate.")
    loads = ledger(spark, lake).where(F.col("run_id") == bad_run)

    log = store.read_log(spark, lake, "quality", QUALITY_LOG_SCHEMA)
    views = marts.build_marts(warehouse)
    warehouse = {name: df for name, df in warehouse.items() if name not in STATES}
    evidence = runs.evidence(
        executive=views["vw_executive_summary"],
        checks=log.where(F.col("run_id") == second["run_id"]),
        assertions=load_assertions(silver, warehouse),
        idempotent=compared,
        bad_fixture_checks=log.where(F.col("run_id") == bad_run),
        layers=runs.layer_row_counts(
            {source: store.read_bronze(spark, lake, source) for source in SOURCES}, silver
        ),
        objects=runs.object_counts(
            {
                **{name: ("BASE TABLE", df) for name, df in warehouse.items()},
                **{name: ("VIEW", df) for name, df in views.items()},
            }
        ),
        customers=warehouse["dim_customer"],
    )
    return {
        "first_run": first,
        "second_run": second,
        "idempotency": idempotency,
        "bad_data_gate": {
            "status": bad["status"],
            "blocking_failures": bad["blocking_failures"],
            "warehouse_load_attempted": not loads.isEmpty(),
        },
        "evidence": evidence,
    }
