"""Current-state operators: latest row per key, and upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, ties broken by all remaining
    columns (nulls lowest), so the survivor does not depend on task order.

    ``max`` over a struct keeps one row per key and map task before the shuffle.
    A key holding a third of all rows therefore reaches its reducer as at most
    one row per map task, and rows are sorted on the key alone.
    """
    payload = [*order, *(c for c in df.columns if c not in keys and c not in order)]
    return (
        df.groupBy(*keys)
        .agg(F.max(F.struct(*payload)).alias("_latest"))
        .select(*(c if c in keys else f"_latest.{c}" for c in df.columns))
    )


def upsert_by_key(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``changes`` plus the rows of ``current`` whose key has no change."""
    changed = changes.select(*keys)
    return current.join(changed, list(keys), "left_anti").unionByName(changes)
