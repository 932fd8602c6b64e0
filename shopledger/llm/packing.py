"""Packing of documents into sequences of a fixed number of tokens, best-two-fit.

A sequence is filled greedily with the largest pieces that fit. If room is left,
its smallest piece gives way to two unpacked pieces that fit the expanded gap more
tightly. Pieces of one length are alike, so the plan is made on the counts of the
lengths over the whole corpus: a filling is repeated as often as its lengths allow
before the next one is sought. The plan's size depends on the sequence length, not
on the corpus. Spark then numbers the pieces of each length and looks up the place
of each number.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.scratch import written
from shopledger.llm.vocabularies import WORD_PIECES, Words, kept

# Pieces of one length numbered by one task.
NUMBERED_AT_ONCE = 200_000


def _id_bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, *, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """The documents as pieces of at most ``size`` tokens: ids of the text, then
    ``end_id``; only longer ones are cut, the last piece may be shorter.

    doc_id, piece (from 0), start, length and ids_crc32 (of little-endian unsigned
    32-bit ids). Null text counts as empty and gives one piece with the end alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept(f"ids:{vocabulary}", lambda: Words(vocabulary, WORD_PIECES, lower=True, value=_id_bytes))
        end, step = _id_bytes([end_id]), 4 * size
        for batch in batches:
            names, parts, starts, lengths, sums = [], [], [], [], []
            texts = batch.column("text").to_pylist()
            for name, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                text = text or ""
                if words.certain(text):
                    ids = b"".join(map(words.__getitem__, words.split(text))) + end
                else:
                    ids = _id_bytes(words.ids(text)) + end
                for i, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    names.append(name)
                    parts.append(i)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    sums.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, type=pa.int64()),
                    pa.array(parts, type=pa.int32()),
                    pa.array(starts, type=pa.int64()),
                    pa.array(lengths, type=pa.int64()),
                    pa.array(sums, type=pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def _best_two(left: np.ndarray, room: int) -> tuple[int, int]:
    """The two available lengths with the largest sum within ``room``."""
    there = np.flatnonzero(left)
    there = there[(there > 0) & (there < room)]
    if not len(there):
        return 0, 0
    at = np.searchsorted(there, room - there, side="right") - 1
    # A length that is there once cannot be taken twice.
    at -= (at >= 0) & (there[at] == there) & (left[there] < 2)
    ok = at >= 0
    if not ok.any():
        return 0, 0
    sums = np.where(ok, there + there[at], 0)
    best = int(np.argmax(sums))
    return int(there[best]), int(there[at[best]])


def plan(counts: dict[int, int], size: int) -> list[tuple[int, dict[int, int]]]:
    """Fillings as (number of sequences, {length: pieces of it in each})."""
    left = np.zeros(size + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] = count
    fillings = []
    while True:
        there = np.flatnonzero(left)
        if not len(there):
            return fillings
        room, filling = size, {}
        while True:
            i = int(np.searchsorted(there, room, side="right")) - 1
            if i < 0:
                break
            length = int(there[i])
            there = there[:i]
            take = min(room // length, int(left[length]))
            filling[length] = take
            room -= take * length
        if room:
            smallest = min(filling)
            spare = left.copy()
            for length, take in filling.items():
                spare[length] -= take
            one, two = _best_two(spare, room + smallest)
            if one + two > smallest:
                filling[smallest] -= 1
                filling[one] = filling.get(one, 0) + 1
                filling[two] = filling.get(two, 0) + 1
                filling = {length: take for length, take in filling.items() if take}
        times = min(int(left[length]) // take for length, take in filling.items())
        for length, take in filling.items():
            left[length] -= take * times
        fillings.append((times, filling))


def _places(fillings: list[tuple[int, dict[int, int]]]) -> list[tuple[int, ...]]:
    """(length, first number, end, first sequence, pieces in each, first offset): the
    pieces of a length with these numbers go to these sequences in turn."""
    out, used, sequence = [], {}, 0
    for times, filling in fillings:
        offset = 0
        for length in sorted(filling, reverse=True):
            take, first = filling[length], used.get(length, 0)
            out.append((length, first, first + take * times, sequence, take, offset))
            used[length] = first + take * times
            offset += take * length
        sequence += times
    return out


def packed(parts: DataFrame, *, size: int) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``, gapless from 0 in each sequence.
    ``parts`` has doc_id, piece, ids_crc32 and ``length`` from 1 to ``size``, and should be a
    written table: it is read several times."""
    spark = parts.sparkSession
    # At most ``size`` rows, whatever the corpus.
    counts = {r["length"]: r["count"] for r in parts.groupBy("length").count().collect()}
    kinds = "length long, first long, end long, sequence long, take long, base long"
    places = spark.createDataFrame(_places(plan(counts, size)), kinds)

    shares = -(-max(counts.values(), default=1) // NUMBERED_AT_ONCE)
    parts = parts.withColumn("_share", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shares)))
    before = Window.partitionBy("length").orderBy("_share").rowsBetween(Window.unboundedPreceding, -1)
    shared = (
        parts.groupBy("length", "_share")
        .count()
        .select("length", "_share", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"))
    )
    order = Window.partitionBy("length", "_share").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (
        parts.withColumn("_number", F.row_number().over(order) - 1)
        .join(shared, ["length", "_share"])
        .withColumn("_number", F.col("_number") + F.col("_before"))
        .drop("_share", "_before")
    )
    within = F.col("_number") - F.col("first")
    return (
        numbered.join(places, "length")
        .where((F.col("_number") >= F.col("first")) & (F.col("_number") < F.col("end")))
        .select(
            *(F.col(c) for c in parts.columns if c != "_share"),
            (F.col("sequence") + F.floor(within / F.col("take"))).cast("long").alias("sequence_id"),
            (F.col("base") + (within % F.col("take")) * F.col("length")).cast("long").alias("offset"),
        )
    )


def packed_documents(docs: DataFrame, *, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """All documents in as few sequences of at most ``size`` tokens as the method
    finds: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Null doc_ids
    and repeated rows are packed like others; an empty table gives no rows."""
    return packed(written(pieces(docs, vocabulary=vocabulary, end_id=end_id, size=size), "pieces"), size=size)
