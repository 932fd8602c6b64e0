"""Joins that stay balanced when a few keys hold much of the data."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SkewPolicy:
    """Whether to split hot keys, and how far.

    Without ``split`` the join is left to AQE's skew join, whatever the size. With
    it, a key with more than ``rows_per_task`` rows is split into parts of about that
    size.
    """

    split: bool = False
    rows_per_task: int = 4_000_000


# Fewer hot keys than this are broadcast: a few MB, whatever the data. A key
# below this share of 10^12 rows has at most 10^7 of them, which one task sorts.
MOST_HOT_KEYS = 100_000

# A leaf without statistics reports about this size (2^63 - 1).
NO_STATISTICS = 2**62


def input_bytes(df: DataFrame) -> int | None:
    """Size of the scanned inputs by Catalyst's leaf statistics, if known."""
    plan = getattr(df, "_jdf", None)
    if plan is None:  # a Connect session has no JVM plan to ask
        return None
    leaves = plan.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return None if max(sizes, default=0) >= NO_STATISTICS else sum(sizes)


def hot_keys(df: DataFrame, key: str, policy: SkewPolicy) -> DataFrame | None:
    """Keys above ``rows_per_task`` with the number of parts to split them into,
    or None where the policy does not ask for it.

    The count is exact and combined map-side, over one pruned column. A key must
    also hold more than one part in ``MOST_HOT_KEYS`` of all rows, so there are
    always fewer such keys than that: this bounds the broadcast in ``skew_join``.
    """
    if not policy.split:
        return None
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    rows = counts.agg(F.sum("_n")).scalar()
    least = F.greatest(F.lit(policy.rows_per_task), F.ceil(rows / MOST_HOT_KEYS))
    return (
        counts.where(F.col("_n") > least)
        .select(key, F.ceil(F.col("_n") / policy.rows_per_task).cast("int").alias("_parts"))
    )


def _with_parts(df: DataFrame, key: str, hot: DataFrame, name: str) -> DataFrame:
    parts = F.broadcast(hot.withColumnRenamed("_parts", name))
    return df.join(parts, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(1)))


def _part_of(row_id: str, parts: str) -> Column:
    # A hash of the row's own id, never rand(): a recomputed task must send
    # each row to the same place.
    return F.pmod(F.xxhash64(row_id), F.col(parts)).cast("int")


def _every_part(parts: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.col(parts) - 1))


def skew_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    left_hot: DataFrame | None = None,
    right_hot: DataFrame | None = None,
    left_id: str | None = None,
    right_id: str | None = None,
) -> DataFrame:
    """Inner equi-join on ``key``; the same rows as ``left.join(right, key)``.

    A key hot on the left is split over parts by ``left_id`` and its right rows
    are repeated once per part; hot on the right, the mirror image; hot on both,
    a grid of parts. Other keys have one part and are shuffled as usual.
    """
    if left_hot is None and right_hot is None:
        return left.join(right, key)
    on = [key]
    if left_hot is not None:
        left = _with_parts(left, key, left_hot, "_lp").withColumn("_l", _part_of(left_id, "_lp"))
        right = _with_parts(right, key, left_hot, "_lp").withColumn("_l", _every_part("_lp"))
        left, right, on = left.drop("_lp"), right.drop("_lp"), [*on, "_l"]
    if right_hot is not None:
        right = _with_parts(right, key, right_hot, "_rp").withColumn("_r", _part_of(right_id, "_rp"))
        left = _with_parts(left, key, right_hot, "_rp").withColumn("_r", _every_part("_rp"))
        left, right, on = left.drop("_rp"), right.drop("_rp"), [*on, "_r"]
    return left.join(right, on).drop("_l", "_r")
