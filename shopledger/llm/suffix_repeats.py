"""Removal of byte strings that repeat anywhere in the corpus.

A byte goes when a string of ``length`` bytes that covers it starts at another
place too. Two steps find all of them.

1. Seeds. Every window of ``length`` bytes picks the ``SEED`` bytes in it with
   the least hash, so equal windows pick equal seeds at equal places. Only seeds
   travel; a seed that occurs once cannot lie in a repeat. Occurrences of a seed
   whose whole surroundings are equal are repeats throughout, and go on as one.
2. Interval expansion. The suffixes that start at one seed, sorted, form an
   interval of a suffix array. It is extended backward breadth-first: at depth d
   each interval is split, stably, by the byte d places before the seed, the
   column of the Burrows-Wheeler transform, so its members share d bytes before
   the seed, and common prefixes come out by increasing depth: d plus the common
   prefix of neighbours, a range minimum over the first order. Members left alone
   drop out, and the expansion ends at the depth where the seed would leave a
   window of ``length`` bytes. All seeds of a part are expanded together.

A seed with more surroundings than one task should hold is split by depth. Windows
that start lo to hi bytes before the seed all hold the lo bytes before it and the
``length`` - hi bytes from it on, so only contexts that agree on these can share one:
they make a part. A part that is still too large has its depths halved; at one depth
its members share the whole window, and nothing is left to compare.

Texts are known by a 64-bit hash of the text, so copies are one text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.batches import chunks, longs, slices, small_batches, texts_of
from shopledger.llm.hashing import Rolling, joined, mix
from shopledger.llm.scratch import written

_U64 = np.uint64
# Bytes of a seed, of 200: shorter seeds are fewer but more of them recur.
SEED = 64
# A seed is chosen by the high 36 bits of its hash, then by place.
_PLACE = (1 << 28) - 1
# Texts are read in pieces that overlap by all but one byte of a window, and so many
# bytes at once: the working memory of seeds() is some hundred times this.
PIECE_BYTES = 1 << 19
# Contexts sent on, and expanded, at once by one task, and neighbours compared at once.
CONTEXTS_AT_ONCE = 4_096
EXPANDED_AT_ONCE = 15_000
COMPARED_AT_ONCE = 4_096
# Rows of texts and contexts in one Arrow batch.
BATCH_ROWS = 1_000
# Rows of one key from which it is hot, and the most keys that can be hot: beyond
# so many, it takes one row in MOST_HOT of all.
HOT_ROWS = 60_000
MOST_HOT = 100_000


def seeds(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Of every chosen seed: hash, hash of its surroundings, number of its text,
    place in the text, bytes before and from it that are in reach of a window."""
    data, offsets = joined(texts)
    reach = length - SEED
    rolling = Rolling(data)
    grams = rolling.windows(SEED)
    span = reach + 1
    if len(grams) < span:
        empty = np.zeros(0, dtype=np.int64)
        return empty.astype(_U64), empty.astype(_U64), empty, empty, empty, empty
    least = (grams & ~_U64(_PLACE)) | np.arange(len(grams), dtype=_U64)
    size = 1
    while size * 2 <= span:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < span:
        least = np.minimum(least[: len(least) - (span - size)], least[span - size :])
    # Windows that lie in one text.
    turns = np.zeros(len(data) + 2, dtype=np.int32)
    long_enough = np.diff(offsets) >= length
    np.add.at(turns, offsets[:-1][long_enough], 1)
    np.add.at(turns, offsets[1:][long_enough] - length + 1, -1)
    inside = np.cumsum(turns)[: len(least)] > 0
    place = np.unique((least[inside] & _U64(_PLACE)).astype(np.int64))
    text = np.searchsorted(offsets, place, side="right") - 1
    start = np.maximum(place - reach, offsets[text])
    end = np.minimum(place + length, offsets[text + 1])
    before, after = place - start, end - place
    # The place of the seed is part of the surroundings.
    around = mix(rolling.ranges(start, end) + before.astype(_U64))
    return grams[place], around, text, place - offsets[text], before, after


def expanded(group: np.ndarray, before: np.ndarray, after: np.ndarray, length: int) -> np.ndarray:
    """For every context and d = 0, 1, ...: whether the window that starts d bytes
    before the seed also starts at the same depth in another context of the group.

    ``after`` holds the bytes from the seed on, ``before`` those before it, nearest
    first; both with 1 added, and 0 beyond the text."""
    n, reach = before.shape
    words = np.zeros((n, -(-after.shape[1] // 8) * 8), dtype=np.uint8)
    words[:, : after.shape[1]] = after
    columns = words.view(">u8")
    order = np.lexsort((*(columns[:, i] for i in range(columns.shape[1] - 1, -1, -1)), group))
    del words, columns
    # Common prefixes of neighbours in the suffix array of the seeds.
    ends = (after != 0).sum(1)
    prefix = np.empty(max(0, n - 1), dtype=np.int64)
    for a in range(0, n - 1, COMPARED_AT_ONCE):
        some = order[a : a + COMPARED_AT_ONCE + 1]
        differ = after[some[1:]] != after[some[:-1]]
        prefix[a : a + len(differ)] = np.where(differ.any(1), differ.argmax(1), after.shape[1])
    prefix = np.minimum(prefix, np.minimum(ends[order[1:]], ends[order[:-1]]))
    prefix[group[order[1:]] != group[order[:-1]]] = 0
    # Range minima: table[k][i] is the least of 2**k entries from i.
    table = [np.r_[0, prefix].astype(np.int16)]
    while (1 << len(table)) <= n:
        half = 1 << (len(table) - 1)
        table.append(np.minimum(table[-1][:-half], table[-1][half:]))

    def common(first: np.ndarray, second: np.ndarray) -> np.ndarray:
        low, width = first + 1, second - first
        level = np.log2(width).astype(np.int64)
        out = np.zeros(len(first), dtype=np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(table[k][low[at]], table[k][second[at] - (1 << int(k)) + 1])
        return out

    hit = np.zeros((n, reach + 1), dtype=bool)
    rank = np.arange(n)
    interval = group[order].astype(np.int64)
    for depth in range(reach + 1):
        if depth:
            column = before[order[rank], depth - 1]
            alive = column > 0
            rank, key = rank[alive], interval[alive] * 256 + column[alive]
            stable = np.argsort(key, kind="stable")
            rank, key = rank[stable], key[stable]
            interval = np.cumsum(np.r_[False, key[1:] != key[:-1]]).astype(np.int64)
        together = interval[1:] == interval[:-1]
        mates = np.r_[False, together] | np.r_[together, False]
        rank, interval = rank[mates], interval[mates]
        if not len(rank):
            break
        together = np.flatnonzero(interval[1:] == interval[:-1])
        enough = together[common(rank[together], rank[together + 1]) >= length - depth]
        hit[order[rank[enough]], depth] = True
        hit[order[rank[enough + 1]], depth] = True
    return hit


def _runs(hit: np.ndarray, length: int) -> list[list[int]]:
    """Covered bytes of each context as [start, end, start, end, ...] from its seed."""
    out = []
    for row in hit:
        starts = -np.flatnonzero(row)[::-1]
        if len(starts):
            cut = np.flatnonzero(np.diff(starts) > length)
            first = starts[np.r_[0, cut + 1]]
            last = starts[np.r_[cut, len(starts) - 1]] + length
            out.append(np.stack((first, last), 1).ravel().tolist())
        else:
            out.append([])
    return out


def _seed_rows(length: int):
    """Seeds of the distinct texts of a part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in (part for whole in batches for part in slices(whole, "text", PIECE_BYTES)):
            keys = batch.column("key").to_pylist()
            texts, names, bases = [], [], []
            for key, text in zip(keys, texts_of(batch.column("text")), strict=True):
                if len(text) >= length and key not in seen:
                    seen.add(key)
                    for base in range(0, max(1, len(text) - length + 1), PIECE_BYTES):
                        texts.append(text[base : base + PIECE_BYTES + length - 1])
                        names.append(key)
                        bases.append(base)
            names_, bases_ = np.array(names, dtype=np.int64), np.array(bases, dtype=np.int64)
            for a, b in chunks(texts, PIECE_BYTES):
                gram, around, text, place, before, after = seeds(texts[a:b], length)
                yield pa.RecordBatch.from_arrays(
                    [
                        longs(gram),
                        longs(around),
                        pa.array(names_[a:b][text]),
                        pa.array((bases_[a:b][text] + place).astype(np.int64)),
                        pa.array(before.astype(np.int16)),
                        pa.array(after.astype(np.int16)),
                    ],
                    ["gram", "around", "key", "place", "before", "after"],
                )

    return run


def _packed():
    """The distinct texts of a part, compressed for the way."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        packer = zstandard.ZstdCompressor(level=1)
        for batch in (part for whole in batches for part in slices(whole, "text", PIECE_BYTES)):
            keys, bodies = [], []
            for key, text in zip(batch.column("key").to_pylist(), texts_of(batch.column("text")), strict=True):
                if key not in seen:
                    seen.add(key)
                    keys.append(key)
                    bodies.append(packer.compress(text))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, type=pa.int64()), pa.array(bodies, type=pa.binary())], ["key", "body"]
            )

    return run


def _contexts(length: int):
    """Bytes around the seeds of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        names = ["gram", "around", "before", "bytes"]
        for batch in batches:
            lists = batch.column("wanted")
            wanted, edges = lists.values, lists.offsets.to_numpy()
            places, befores, afters = (wanted.field(c).to_numpy() for c in ("place", "before", "after"))
            first, cut = int(edges[0]), []
            for body, a, b in zip(batch.column("body"), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                text = unpack.decompress(body.as_py()) if b > a else b""
                for k in range(a, b):
                    cut.append(text[places[k] - befores[k] : places[k] + afters[k]])
                    if len(cut) == CONTEXTS_AT_ONCE or k + 1 == edges[-1]:
                        sent = (wanted.field(c).slice(first, len(cut)) for c in names[:-1])
                        yield pa.RecordBatch.from_arrays([*sent, pa.array(cut, type=pa.binary())], names)
                        first, cut = k + 1, []

    return run


def _expansion(length: int):
    """Rows come sorted by part; whole parts are expanded together."""

    def runs(table: pa.Table) -> pa.RecordBatch:
        reach = length - SEED
        part = table.column("part").to_numpy()
        at = table.column("before").to_numpy()
        before = np.zeros((len(part), reach), dtype=np.uint8)
        after = np.zeros((len(part), length), dtype=np.uint8)
        for i, (b, text) in enumerate(zip(at.tolist(), table.column("bytes"), strict=True)):
            row = np.frombuffer(text.as_buffer(), dtype=np.uint8)
            before[i, :b] = row[:b][::-1] + 1
            after[i, : len(row) - b] = row[b:] + 1
        group = np.cumsum(np.r_[False, part[1:] != part[:-1]])
        spans = _runs(expanded(group, before, after, length), length)
        return pa.RecordBatch.from_arrays(
            [
                table.column("gram").combine_chunks(),
                table.column("around").combine_chunks(),
                pa.array(spans, type=pa.list_(pa.int32())),
            ],
            ["gram", "around", "spans"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part").to_numpy()
            other = np.flatnonzero(part != part[-1])
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                held.append(batch.slice(0, cut))
                rows += cut
                if rows >= EXPANDED_AT_ONCE:
                    yield runs(pa.Table.from_batches(held))
                    held, rows = [], 0
            held.append(batch.slice(cut))
            rows += batch.num_rows - cut
        if held:
            yield runs(pa.Table.from_batches(held))

    return run


def _merged(spans: np.ndarray, size: int) -> np.ndarray:
    """Disjoint covered ranges of [0, size) from flat [start, end, ...]."""
    pairs = spans.reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    start, end = np.maximum(pairs[:, 0], 0), np.minimum(np.maximum.accumulate(pairs[:, 1]), size)
    fresh = np.r_[True, start[1:] > end[:-1]] if len(start) else np.zeros(0, dtype=bool)
    firsts = np.flatnonzero(fresh)
    lasts = np.r_[firsts[1:] - 1, len(start) - 1] if len(firsts) else firsts
    return np.stack((start[firsts], end[lasts]), 1)


def _results(length: int):
    """Per distinct text the removed ranges and what stays."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for key, body, copies, spans in zip(
                *(batch.column(c).to_pylist() for c in ("key", "body", "copies", "spans")), strict=True
            ):
                text = unpack.decompress(body)
                flat = np.array(spans or [], dtype=np.int64)
                if copies > 1 and len(text) >= length:
                    flat = np.array([0, len(text)])
                ranges = _merged(flat, len(text))
                kept, last = [], 0
                for a, b in ranges:
                    kept.append(text[last:a])
                    last = int(b)
                kept.append(text[last:])
                stays = b"".join(kept)
                rows.append((key, len(text), len(text) - len(stays), len(ranges), hashlib.sha256(stays).hexdigest(), ranges.ravel().tolist()))
            columns = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(columns, types, strict=True)],
                ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "ranges"],
            )

    return run


def _least(rows: DataFrame) -> int:
    """Rows above which a key of a written table is hot."""
    return max(HOT_ROWS, rows.count() // MOST_HOT)


def _matched(rows: DataFrame, keys: DataFrame, by: list[str], least: int) -> DataFrame:
    """``rows`` joined with ``keys``, which has one row per key with its count in
    ``rows``. Rows of hot keys, fewer than MOST_HOT by their counts, stay where they are."""
    hot = keys.where(F.col("rows") > least)
    there = rows.join(F.broadcast(hot), by)
    sent = rows.join(F.broadcast(hot.select(*by)), by, "left_anti").join(keys.where(F.col("rows") <= least), by)
    return there.unionByName(sent)


CONTEXT = ["gram", "around", "before", "bytes"]


def _parted(contexts: DataFrame, length: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """The contexts of hot seeds by parts to expand, and the spans of the contexts
    that share a whole window with more others than a task should hold."""
    parts, spans = [], []
    left = contexts.select(*CONTEXT, F.lit(0).alias("lo"), F.lit(length - SEED).alias("hi"))
    while not left.isEmpty():
        middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
        lower = F.struct(F.col("lo").alias("lo"), middle.alias("hi"))
        upper = F.struct((middle + 1).alias("lo"), F.col("hi").alias("hi"))
        agreed = F.expr(f"substring(bytes, before - lo + 1, lo + {length} - hi)")
        halves = written(
            left.select(*CONTEXT, F.explode(F.array(lower, upper)).alias("depths"))
            .select(*CONTEXT, "depths.lo", "depths.hi")
            .where(f"before >= lo and length(bytes) - before >= {length} - hi")
            .withColumn("part", F.xxhash64("gram", "lo", "hi", agreed)),
            "repeat-parts",
        )
        rows = halves.groupBy("part").agg(F.count("*").alias("rows")).where(F.col("rows") > _least(halves))
        judged = halves.join(F.broadcast(rows), "part", "left")
        parts.append(judged.where("rows is null").select(*CONTEXT, "part"))
        share = F.array(-F.col("lo"), F.lit(length) - F.col("lo")).alias("spans")
        spans.append(judged.where("rows is not null and lo = hi").select("gram", "around", share))
        left = judged.where("rows is not null and lo < hi")
    return parts, spans


def repeated_ranges(docs: DataFrame, *, length: int) -> DataFrame:
    """For each distinct text of ``docs`` what of it repeats: ``key`` (the xxhash64
    of the text), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` and
    ``ranges``, the flat [start, end, ...] byte ranges to remove.

    Null text counts as empty. Texts under ``length`` bytes keep all. Rows with the
    same text are occurrences of each other. Only the column text is read.
    """
    with small_batches(docs.sparkSession, BATCH_ROWS):
        return _repeated_ranges(docs, length)


def _repeated_ranges(docs: DataFrame, length: int) -> DataFrame:
    keyed = docs.select(F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    kinds = "gram long, around long, key long, place long, before short, after short"
    found = written(keyed.mapInArrow(_seed_rows(length), kinds), "repeat-seeds")
    least = _least(found)
    # Seeds that recur, with whether their surroundings differ.
    grams = written(
        found.groupBy("gram")
        .agg(F.count("*").alias("rows"), F.min("around").alias("lo"), F.max("around").alias("hi"))
        .where("rows > 1")
        .select("gram", "rows", (F.col("lo") != F.col("hi")).alias("mixed")),
        "repeat-grams",
    )
    hits = written(_matched(found, grams, ["gram"], least).drop("rows"), "repeat-hits")
    # One row per surroundings of a seed, with an occurrence as their sample.
    samples = written(
        hits.groupBy("gram", "around", "mixed")
        .agg(F.count("*").alias("rows"), F.min(F.struct("key", "place", "before", "after")).alias("sample"))
        .select("gram", "around", "mixed", "rows", "sample.*"),
        "repeat-samples",
    )
    copies = keyed.groupBy("key").agg(F.count("*").alias("copies"))
    bodies = keyed.mapInArrow(_packed(), "key long, body binary").repartition("key")

    def contexts(rows: DataFrame) -> DataFrame:
        wanted = rows.groupBy("key").agg(
            F.collect_list(F.struct("gram", "around", "place", "before", "after")).alias("wanted")
        )
        return bodies.join(wanted, "key").mapInArrow(
            _contexts(length), "gram long, around long, before short, bytes binary"
        )

    mixed = samples.where("mixed")
    hot = written(
        mixed.groupBy("gram").agg(F.count("*").alias("rows")).where(F.col("rows") > least).select("gram"), "repeat-hot"
    )
    parts, spans = [], []
    if not hot.isEmpty():
        parts, spans = _parted(contexts(mixed.join(F.broadcast(hot), "gram", "left_semi")), length)
        mixed = mixed.join(F.broadcast(hot), "gram", "left_anti")
    expanding = contexts(mixed).withColumn("part", F.col("gram"))
    for more in parts:
        expanding = expanding.unionByName(more)
    shared = (
        expanding.repartition("part")
        .sortWithinPartitions("part")
        .mapInArrow(_expansion(length), "gram long, around long, spans array<int>")
        .where(F.size("spans") > 0)
    )
    for more in spans:
        shared = shared.unionByName(more)
    shared = written(shared, "repeat-spans")
    place = F.col("place")
    whole = _matched(hits, samples.where("rows > 1").select("gram", "around", "rows"), ["gram", "around"], least).select(
        "key", F.array(place - F.col("before"), place + F.col("after")).alias("spans")
    )
    part = samples.where("mixed and rows = 1").join(shared, ["gram", "around"]).select(
        "key", F.transform("spans", lambda x: x + place).alias("spans")
    )
    covered = whole.unionByName(part).groupBy("key").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    texts = bodies.join(copies, "key").join(covered, "key", "left").select("key", "body", "copies", "spans")
    result = texts.mapInArrow(
        _results(length),
        "key long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, ranges array<long>",
    )
    return written(result.dropDuplicates(["key"]), "repeat-results")


def _unused(docs: DataFrame, name: str) -> str:
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def _cut(name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            out = []
            for text, ranges in zip(batch.column(at).to_pylist(), batch.column(name).to_pylist(), strict=True):
                if ranges:
                    raw, kept, last = text.encode(), [], 0
                    for a, b in zip(ranges[::2], ranges[1::2], strict=True):
                        kept.append(raw[last:a])
                        last = b
                    # A range may begin or end inside a character; its rest goes too.
                    text = b"".join([*kept, raw[last:]]).decode("utf-8", "ignore")
                out.append(text)
            columns = [pa.array(out, type=pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names).drop_columns([name])

    return run


def without_repeats(docs: DataFrame, *, length: int) -> DataFrame:
    """``docs`` with the repeated bytes cut out of ``text``; other columns stay,
    whatever their names. A null text stays null. A character of which a byte goes, goes."""
    key, cut = _unused(docs, "key"), _unused(docs, "ranges")
    named = F.xxhash64(F.coalesce("text", F.lit("")))
    ranges = repeated_ranges(docs, length=length).where("n_removed > 0")
    ranges = ranges.select(F.col("key").alias(key), F.col("ranges").alias(cut))
    rows = docs.withColumn(key, named).join(ranges, key, "left").drop(key)
    return rows.mapInArrow(_cut(cut), docs.schema)


def removal_report(docs: DataFrame, *, length: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans and
    kept_sha256 of the bytes that stay. A null doc_id stays null."""
    keyed = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"))
    result = repeated_ranges(docs, length=length).drop("ranges")
    return keyed.join(result, "key").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
