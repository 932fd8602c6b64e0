"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A row's key falls on an arc of the ring; each arc belongs to a shard. A shard takes
rows up to its bound, and what overflows continues clockwise to the next arc whose
shard has room. The overflow is settled on the counts of the arcs, whose number is
fixed, so the driver sees shards times virtual nodes numbers; Spark numbers the
rows of each arc and looks up where each number goes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.hashing import mix
from shopledger.llm.scratch import written

_RING_BITS = 62
# Rows of one arc numbered by one task.
NUMBERED_AT_ONCE = 200_000


@dataclass(frozen=True)
class Ring:
    """``starts[i]`` begins the arc of shard ``owners[i]``, by rising start; the last
    arc goes on over zero to the first start."""

    starts: np.ndarray
    owners: np.ndarray


def ring(shards: int, virtual_nodes: int) -> Ring:
    """The points of a shard depend on its number alone, so another shard only
    takes arcs, and moves rows to itself only."""
    ids = np.arange(shards * virtual_nodes, dtype=np.uint64)
    points = (mix(ids + np.uint64(0x51ED270B)) >> np.uint64(64 - _RING_BITS)).astype(np.int64)
    order = np.argsort(points, kind="stable")
    return Ring(points[order], (ids[order] // np.uint64(virtual_nodes)).astype(np.int64))


def capacities(total: int, shards: int, slack: float) -> list[int]:
    """Most rows of each shard: the mean and ``slack`` of it more. Without slack the
    bounds sum to the total, and any two are at most one apart."""
    if slack:
        return [int(np.ceil(total / shards * (1 + slack)))] * shards
    return [total // shards + (s < total % shards) for s in range(shards)]


def settle(on: Ring, counts: np.ndarray, bounds: list[int]) -> list[tuple[int, int, int, int]]:
    """Where the rows of each arc go: (arc, first number, end, shard). Each shard
    first takes its own arcs' rows in ring order up to its bound; then the rest of
    each arc goes clockwise to shards that still have room."""
    room = list(bounds)
    out, over = [], []
    for arc, count in enumerate(counts.tolist()):
        shard = int(on.owners[arc])
        take = min(count, room[shard])
        room[shard] -= take
        if take:
            out.append((arc, 0, take, shard))
        if take < count:
            over.append((arc, take, count))
    n = len(on.owners)
    for arc, first, end in over:
        step = 1
        while first < end:
            shard = int(on.owners[(arc + step) % n])
            take = min(end - first, room[shard])
            if take:
                out.append((arc, first, first + take, shard))
                room[shard] -= take
                first += take
            step += 1
    return out


def _with_arc(rows: DataFrame, on: Ring) -> DataFrame:
    """``rows`` with the number of the arc that ``point`` lies on: a binary search
    in the sorted starts, one column a step."""
    starts = f"array({', '.join(f'{int(x)}L' for x in on.starts)})"
    rows = rows.withColumn("arc", F.lit(0))
    step = 1 << (len(on.starts) - 1).bit_length()
    while step:
        rows = rows.withColumn(
            "arc",
            F.expr(
                f"CASE WHEN arc + {step} <= {len(on.starts)} AND get({starts}, arc + {step - 1}) <= point"
                f" THEN arc + {step} ELSE arc END"
            ),
        )
        step //= 2
    # Points before the first start lie on the last arc, which goes on over zero.
    return rows.withColumn("arc", F.when(F.col("arc") == 0, len(on.starts) - 1).otherwise(F.col("arc") - 1))


def sharded(docs: DataFrame, *, shards: int, virtual_nodes: int = 64, slack: float = 0.0) -> DataFrame:
    """Every row of ``docs`` in one of ``shards`` shards, by doc_id: doc_id, size
    (UTF-8 bytes of the text and 1; null text: 1), text_crc32 (null counts as
    empty), shard and slot, gapless from 0 in each shard.

    With no slack the shards' row counts are at most one apart. Rows without doc_id
    are placed by their text. Repeated rows are rows like others."""
    spark = docs.sparkSession
    on = ring(shards, virtual_nodes)
    text = F.coalesce("text", F.lit(""))
    placed = docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    ).withColumn(
        "point",
        F.shiftrightunsigned(F.xxhash64(F.coalesce("doc_id", "text_crc32").cast("long")), 64 - _RING_BITS),
    )
    found = written(_with_arc(placed, on), "ring-rows")
    n = len(on.starts)
    counts = np.zeros(n, dtype=np.int64)
    # One row per arc.
    for r in found.groupBy("arc").count().collect():
        counts[r["arc"]] = r["count"]
    parts, used = [], [0] * shards
    for arc, first, end, shard in sorted(settle(on, counts, capacities(int(counts.sum()), shards, slack))):
        parts.append((arc, first, end, shard, used[shard] - first))
        used[shard] += end - first
    places = spark.createDataFrame(parts, "arc int, first long, end long, shard int, shift long")

    shares = max(1, -(-int(counts.max(initial=1)) // NUMBERED_AT_ONCE))
    found = found.withColumn("share", F.pmod(F.xxhash64("point", "text_crc32"), F.lit(shares)))
    before = Window.partitionBy("arc").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        found.groupBy("arc", "share")
        .count()
        .select("arc", "share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    )
    order = Window.partitionBy("arc", "share").orderBy("point", "doc_id", "text_crc32", "size")
    numbered = (
        found.withColumn("number", F.row_number().over(order) - 1)
        .join(shared, ["arc", "share"])
        .withColumn("number", F.col("number") + F.col("before"))
    )
    return (
        numbered.join(places, "arc")
        .where((F.col("number") >= F.col("first")) & (F.col("number") < F.col("end")))
        .select("doc_id", "size", "text_crc32", "shard", (F.col("number") + F.col("shift")).alias("slot"))
    )
