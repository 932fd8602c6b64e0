"""Run ledger, idempotency, publish guard and evidence."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.operators import latest_by_key, upsert_by_key
from shopledger.plans.quality import gate_verdict
from shopledger.plans.silver import Silver, row_counts
from shopledger.plans.warehouse import Warehouse
from shopledger.schemas import PROTECTED_COLUMNS, RAW_PERSONAL_COLUMNS


def record_runs(ledger: DataFrame, runs: DataFrame) -> DataFrame:
    """The ledger with one row per run: a repeated run replaces its row."""
    return upsert_by_key(ledger, runs, ["run_id"])


def current_runs(ledger_log: DataFrame) -> DataFrame:
    """Ledger state from its append-only log."""
    return latest_by_key(ledger_log, ["run_id"], ["loaded_at"])


def last_loaded_run(ledger: DataFrame) -> DataFrame:
    """The most recently loaded run, as one row."""
    return ledger.orderBy(F.desc("loaded_at"), F.desc("run_id")).limit(1)


def run_verdicts(quality_log: DataFrame) -> DataFrame:
    """Status of each run from its logged check rows. A repeated gate replaces
    the rows of the earlier one."""
    latest = latest_by_key(quality_log, ["run_id", "check_name"], ["checked_at"])
    failed = F.count_if(F.col("blocking") & ~F.col("passed"))
    return (
        latest.groupBy("run_id")
        .agg(failed.alias("blocking_failures"), F.max("checked_at").alias("checked_at"))
        .withColumn(
            "status", F.when(F.col("blocking_failures") > 0, "failed").otherwise("passed")
        )
    )


def publishable_run(ledger: DataFrame, quality_log: DataFrame) -> DataFrame:
    """The last loaded run if its own gate passed, else no row. A newer report
    of some other run has no say in it."""
    last = last_loaded_run(ledger).select("run_id", "loaded_at", "fact_sales_rows")
    return (
        last.join(run_verdicts(quality_log), "run_id")
        .where(F.col("status") == "passed")
        .select("run_id", "loaded_at", "fact_sales_rows", "status")
    )


def warehouse_metrics(warehouse: Warehouse, ledger: DataFrame) -> DataFrame:
    """Fact rows, distinct sales keys, event rows and number of runs."""
    events = warehouse["fact_campaign_events"].agg(F.count(F.lit(1)))
    runs = ledger.agg(F.count(F.lit(1)))
    return (
        warehouse["fact_sales"]
        .agg(
            F.count(F.lit(1)).alias("fact_sales_rows"),
            F.count_distinct("sales_key").alias("distinct_sales_keys"),
        )
        .withColumns(
            {"fact_campaign_rows": events.scalar(), "pipeline_runs": runs.scalar()}
        )
    )


def idempotency(first: DataFrame, second: DataFrame) -> DataFrame:
    """Compare the sales keys of two loads of the same data in one aggregate."""
    tagged = first.select("sales_key", F.lit(1).alias("_first"), F.lit(0).alias("_second")).union(
        second.select("sales_key", F.lit(0), F.lit(1))
    )
    per_key = tagged.groupBy("sales_key").agg(
        F.sum("_first").alias("_first"), F.sum("_second").alias("_second")
    )
    return per_key.agg(
        F.coalesce(F.sum("_first"), F.lit(0)).alias("first_fact_rows"),
        F.coalesce(F.sum("_second"), F.lit(0)).alias("second_fact_rows"),
        F.count_if(F.col("_second") > 0).alias("distinct_sales_keys"),
        F.count_if(F.col("_second") == 0).alias("keys_only_in_first"),
        F.count_if(F.col("_first") == 0).alias("keys_only_in_second"),
    ).withColumn(
        "passed",
        (F.col("first_fact_rows") == F.col("second_fact_rows"))
        & (F.col("second_fact_rows") == F.col("distinct_sales_keys"))
        & (F.col("keys_only_in_first") == 0)
        & (F.col("keys_only_in_second") == 0),
    )


def object_counts(objects: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """One row per object (type, frame), ordered by type and name."""
    kinds = F.create_map(
        *(F.lit(x) for name, (kind, _) in objects.items() for x in (name, kind))
    )
    frames = {name: df for name, (_, df) in objects.items()}
    return (
        row_counts(frames, "object_name", "row_count")
        .select("object_name", kinds[F.col("object_name")].alias("object_type"), "row_count")
        .orderBy("object_type", "object_name")
    )


def catalog_objects(spark: SparkSession, prefixes: tuple[str, ...]) -> dict[str, tuple[str, DataFrame]]:
    """Tables and views of the session catalog whose name has a given prefix."""
    return {
        table.name: (
            "VIEW" if table.isTemporary or table.tableType == "VIEW" else "BASE TABLE",
            spark.table(table.name),
        )
        for table in spark.catalog.listTables()
        if table.name.startswith(prefixes)
    }


def layer_row_counts(bronze: Mapping[str, DataFrame], silver: Silver) -> DataFrame:
    """Rows of each dataset in Bronze and in Silver."""
    return row_counts(bronze, "dataset", "bronze_rows").join(
        row_counts(silver, "dataset", "silver_rows"), "dataset"
    )


def _section(name: str, df: DataFrame) -> DataFrame:
    """A one-row frame as (section, metric, value) rows."""
    text = df.select(*(F.col(c).cast("string").alias(c) for c in df.columns))
    return text.unpivot([], df.columns, "metric", "value").select(
        F.lit(name).alias("section"), "metric", "value"
    )


def _listed(name: str, df: DataFrame, metric: str, value: Column) -> DataFrame:
    return df.select(
        F.lit(name).alias("section"),
        F.col(metric).alias("metric"),
        value.cast("string").alias("value"),
    )


def evidence(
    *,
    executive: DataFrame,
    checks: DataFrame,
    assertions: DataFrame,
    idempotent: DataFrame,
    bad_fixture_checks: DataFrame,
    layers: DataFrame,
    objects: DataFrame,
    customers: DataFrame,
) -> DataFrame:
    """Everything a reviewer checks after a run as (section, metric, value)."""
    columns = {c.lower() for c in customers.columns}
    exposed = sorted(columns & set(RAW_PERSONAL_COLUMNS))
    protected = sorted(columns & set(PROTECTED_COLUMNS))
    privacy = customers.agg(F.count(F.lit(1)).alias("customers")).select(
        F.lit(", ".join(protected)).alias("protected_columns"),
        F.lit(", ".join(exposed)).alias("raw_columns"),
        F.lit(", ".join(sorted(RAW_PERSONAL_COLUMNS))).alias("removed_columns"),
        "customers",
    )
    sections = [
        _section("executive", executive),
        _listed("quality", checks, "check_name", F.when(F.col("passed"), "passed").otherwise("failed")),
        _section("privacy", privacy),
        _section("reconciliation", assertions),
        _section("idempotency", idempotent),
        _section("bad_fixture", gate_verdict(bad_fixture_checks)),
        _listed("bronze_rows", layers, "dataset", F.col("bronze_rows")),
        _listed("silver_rows", layers, "dataset", F.col("silver_rows")),
        _listed("objects", objects, "object_name", F.col("row_count")),
    ]
    return reduce(DataFrame.unionByName, sections)
