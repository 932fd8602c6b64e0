"""Packing of documents into windows of a fixed number of tokens, best-fit decreasing.

A document longer than a window is first cut into full windows; what is left of it and
the shorter documents go, longest first, each into the open window with the least room
that takes it. A segment tree over the rooms 0 .. size, which counts the open windows of
each room, finds that window in as many steps as the tree is deep.

Pieces of one length are alike, and so are windows of one room. The plan is therefore
made on the number of pieces of each length, and a run of windows takes pieces of a
length in one step, with the result of taking them one by one. Its size depends on the
window, not on the corpus. Spark numbers the pieces of each length and looks up where
each number goes.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.llm.scratch import written
from shopledger.llm.vocabularies import BYTE_PIECES, Words, kept

# Bytes of token ids given out at once by a task that cuts documents.
_OUT_BYTES = 8_000_000


def _id_bytes(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def pieces(docs: DataFrame, *, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """``docs`` (doc_id, text) as token pieces: ids of the text by the byte-level
    ``vocabulary``, then ``end_id``, cut into full windows of ``size`` and what is left.

    doc_id, start (tokens of the document before the piece), length, doc_tokens, ids
    (little-endian unsigned 32-bit), and part and number: the piece's task, and its place
    among the pieces of its length there. Write the result before use: a task's number
    holds for one computation. Null text counts as empty and gives the end alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = kept(f"ids:{vocabulary}", lambda: Words(vocabulary, BYTE_PIECES, lower=False, value=_id_bytes))
        end, step = _id_bytes([end_id]), 4 * size
        part = TaskContext.get().partitionId()
        met = [0] * (size + 1)
        names, starts, lengths, totals, blobs, numbers = [], [], [], [], [], []
        held = 0

        def out() -> pa.RecordBatch:
            n = len(names)
            columns = [
                pa.array(names, type=pa.int64()),
                pa.array(starts, type=pa.int64()),
                pa.array(lengths, type=pa.int32()),
                pa.array(totals, type=pa.int64()),
                pa.array(blobs, type=pa.binary()),
                pa.array(np.full(n, part, dtype=np.int32)),
                pa.array(numbers, type=pa.int64()),
            ]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "doc_tokens", "ids", "part", "number"])

        for batch in batches:
            for name, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                text = text or ""
                if words.certain(text):
                    ids = b"".join(map(words.__getitem__, words.split(text))) + end
                else:
                    ids = _id_bytes(words.ids(text)) + end
                for at in range(0, len(ids), step):
                    blob = ids[at : at + step]
                    length = len(blob) // 4
                    names.append(name)
                    starts.append(at // 4)
                    lengths.append(length)
                    totals.append(len(ids) // 4)
                    blobs.append(blob)
                    numbers.append(met[length])
                    met[length] += 1
                    held += len(blob)
                    if held >= _OUT_BYTES:
                        yield out()
                        for values in (names, starts, lengths, totals, blobs, numbers):
                            values.clear()
                        held = 0
        yield out()

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, start long, length int, doc_tokens long, ids binary, part int, number long"
    )


class Rooms:
    """Open windows by the room left in them: a segment tree of their counts."""

    def __init__(self, size: int) -> None:
        self._leaves = 1 << size.bit_length()
        self._counts = [0] * (2 * self._leaves)

    def add(self, room: int, windows: int) -> None:
        i = self._leaves + room
        while i:
            self._counts[i] += windows
            i //= 2

    def tightest(self, need: int) -> int | None:
        """The least room of at least ``need`` that a window has."""
        i = self._leaves + need
        if not self._counts[i]:
            # Up to the first right neighbour with windows, then down its left side.
            while i > 1 and (i % 2 or not self._counts[i + 1]):
                i //= 2
            if i == 1:
                return None
            i += 1
            while i < self._leaves:
                i = 2 * i if self._counts[2 * i] else 2 * i + 1
        return i - self._leaves


@dataclass(frozen=True)
class Place:
    """Pieces ``first`` to ``end`` of a length go to the windows from ``window`` on,
    ``each`` to a window, side by side from ``offset``."""

    length: int
    first: int
    end: int
    window: int
    each: int
    offset: int


def plan(counts: Mapping[int, int], size: int) -> list[Place]:
    """Where the pieces of each length go, longest first."""
    rooms = Rooms(size)
    runs: list[deque[tuple[int, int]]] = [deque() for _ in range(size + 1)]
    places, windows = [], 0

    def opened(room: int, first: int, count: int) -> None:
        if count and room:
            rooms.add(room, count)
            runs[room].append((first, count))

    for length in sorted(counts, reverse=True):
        left, number = counts[length], 0
        while left:
            room = rooms.tightest(length)
            if room is None:
                room, more = size, -(-left // (size // length))
                opened(room, windows, more)
                windows += more
            first, count = runs[room].popleft()
            rooms.add(room, -count)
            # A window that takes one takes the next as well while it fits, being the tightest then.
            each = min(room // length, left)
            taking = min(count, left // each)
            places.append(Place(length, number, number + taking * each, first, each, size - room))
            number += taking * each
            left -= taking * each
            opened(room - each * length, first, taking)
            if taking < count:
                rooms.add(room, count - taking)
                runs[room].appendleft((first + taking, count - taking))
    return places


def _placed(places: list[Place], columns: list[str]):
    """Adds the window and the offset to rows with length and ``_number``."""
    # One sorted key of length and number; a length has fewer than 2**40 pieces.
    key = np.array([(p.length << 40) + p.first for p in places], dtype=np.int64)
    order = np.argsort(key)
    key = key[order]
    first, window, each, offset = (
        np.array([getattr(p, f) for p in places], dtype=np.int64)[order] for f in ("first", "window", "each", "offset")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            number = batch.column("_number").to_numpy(zero_copy_only=False)
            at = np.searchsorted(key, (length << 40) + number, side="right") - 1
            within = number - first[at]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in columns),
                    pa.array(window[at] + within // each[at]),
                    pa.array(offset[at] + within % each[at] * length),
                ],
                [*columns, "sequence_id", "offset"],
            )

    return run


def packed(parts: DataFrame, *, size: int) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``, gapless from 0 in each window, in
    place of part and number. ``parts`` is a written table of ``pieces`` or columns of
    it, with length, part and number; only those travel with other columns asked for."""
    runs = parts.groupBy("length", "part").agg(F.count("*").alias("_n"))
    # At most ``size`` lengths, whatever the corpus.
    counts = {r["length"]: r["n"] for r in runs.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    # One row per length and task.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("length", "part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    numbered = parts.join(runs, ["length", "part"]).withColumn("_number", F.col("number") + F.col("_before"))
    columns = [c for c in parts.columns if c not in ("part", "number")]
    kinds = T.StructType(
        [
            *(parts.schema[c] for c in columns),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )
    return numbered.select(*columns, "_number").mapInArrow(_placed(plan(counts, size), columns), kinds)


def packed_documents(docs: DataFrame, *, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """All documents in windows of at most ``size`` tokens: doc_id, start, length,
    doc_tokens, ids, sequence_id, offset. Null doc_ids and repeated rows are packed like
    others; an empty table gives no rows. Columns of ``docs`` besides doc_id and text
    are not read."""
    return packed(written(pieces(docs, vocabulary=vocabulary, end_id=end_id, size=size), "window-pieces"), size=size)


def sequences(placed: DataFrame) -> DataFrame:
    """The windows that ``packed_documents`` fills: sequence_id, n_tokens, ids (little-
    endian unsigned 32-bit) and starts, where each piece begins. A window holds no more
    pieces than it has tokens."""
    held = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    grouped = placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), held.alias("_held"))
    whole = F.aggregate("_held", F.lit(b""), lambda ids, piece: F.concat(ids, piece["ids"]))
    return grouped.select("sequence_id", "n_tokens", whole.alias("ids"), F.col("_held.offset").alias("starts"))


def packing_report(docs: DataFrame, *, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """Where each piece of ``packed_documents`` lies, with the CRC-32 of its ids in
    place of them: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    parts = written(pieces(docs, vocabulary=vocabulary, end_id=end_id, size=size), "window-pieces")
    digests = parts.select(
        "doc_id", "start", F.col("length").cast("int"), F.crc32("ids").alias("ids_crc32"), "doc_tokens", "part", "number"
    )
    return packed(digests, size=size).withColumn("length", F.col("length").cast("long"))
