"""High-water-mark extraction."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.schemas import EPOCH_WATERMARK, REJECTED_RECORD


def as_timestamp(moment: str | datetime) -> Column:
    return F.lit(moment).cast("timestamp")


def changed_since(
    df: DataFrame,
    watermark: str | datetime = EPOCH_WATERMARK,
    *,
    lookback: timedelta = timedelta(0),
) -> DataFrame:
    """Rows changed strictly after the watermark.

    ``lookback`` reads a little further back for rows that were committed late
    with an older ``updated_at``; the Silver deduplication absorbs the repeats.
    The bound is a literal, so it reaches a Parquet or JDBC scan as a filter.
    """
    bound = as_timestamp(watermark)
    if lookback:
        bound = bound - F.lit(lookback)
    changed = F.col("updated_at") > bound
    if REJECTED_RECORD in df.columns:
        # A record that could not be read has no time to compare.
        changed = changed | F.col(REJECTED_RECORD).isNotNull()
    return df.where(changed)


def extract_summary(changed: DataFrame, source: str, watermark: str | datetime) -> DataFrame:
    """One row for a batch: size and the watermark before and after it. An empty
    batch leaves the watermark, and a lookback batch never lowers it."""
    before = as_timestamp(watermark)
    return changed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("updated_at").alias("_newest"),
    ).select(
        F.lit(source).alias("source"),
        "rows",
        before.alias("watermark_before"),
        F.greatest(F.col("_newest"), before).alias("watermark_after"),
    )


def extract_manifest(
    sources: Mapping[str, DataFrame],
    watermarks: Mapping[str, str | datetime],
    *,
    run_id: str,
) -> DataFrame:
    """One row per source for a run, with the total of its rows. A source
    without a watermark is read from the beginning."""
    summaries = []
    for name, df in sources.items():
        mark = watermarks.get(name, EPOCH_WATERMARK)
        summaries.append(extract_summary(changed_since(df, mark), name, mark))
    # The window spans one row per source.
    total = F.sum("rows").over(Window.partitionBy(F.lit(run_id)))
    return reduce(DataFrame.unionByName, summaries).select(
        F.lit(run_id).alias("run_id"), "*", total.alias("total_rows")
    )
