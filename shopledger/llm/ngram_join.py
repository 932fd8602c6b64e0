"""Exact Jaccard join of documents on word shingles, by universe partition.

Method: the universe of shingle hashes is cut into m segments. Two sets whose
symmetric difference is at most H agree on a whole segment when m > H, and with
d of the segments also indexed by their one-deletion neighbourhoods already when
m + d > H (pigeonhole with one more allowed difference in d segments). H follows
from the threshold and the sizes, so sets are handled by size bands. How many
segments get deletion neighbourhoods is chosen per band by cost.

Documents with equal shingle sets are one set from the start. Sets that share a
signature are first compared with the smallest of the bucket, and links found so
are closed to components; only then are buckets that still hold several components
searched: their pairs, thinned out by parity sketches that never reject a link, are
verified on the whole texts; the rows of buckets with too many sets or pairs left carry
their shingles and send only links that join components, fewer than they have rows. So a bucket of
many near copies sends about its size, and no group is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.batches import chunks, longs, texts_of
from shopledger.llm.components import components
from shopledger.llm.hashing import mix, mix_int, shingle_sets
from shopledger.llm.scratch import written

_U64 = np.uint64
# Each band reaches to this times its smallest size. Wider bands have more
# segments than their small sets need, narrower ones put more sets into two bands.
BAND_RATIO = 1.25
# Cost of comparing one pair of a bucket by size and sketch, where handling one
# index entry costs 1, and the share of pairs of a band that have passages in common.
PAIR_COST = 0.03
RELATED_PAIRS = 1e-3
# Chance that a shingle of such a pair is in both. These figures only steer cost.
SHARED_SHINGLE = 0.55


@dataclass(frozen=True)
class Threshold:
    """Two sets link when den * |A and B| >= num * |A or B|."""

    num: int
    den: int

    def difference(self, total: int) -> int:
        """Largest symmetric difference of linked sets with sizes summing to ``total``."""
        common = -(-self.num * total // (self.num + self.den))
        return total - 2 * common

    def smallest_partner(self, size: int) -> int:
        return -(-self.num * size // self.den)


@dataclass(frozen=True)
class Band:
    """Sets of sizes [low, high), with smaller partners down to ``reach``."""

    number: int
    low: int
    high: int
    reach: int
    segments: int
    deletions: int


def size_bounds(largest: int) -> list[int]:
    bounds = [1]
    while bounds[-1] <= largest:
        bounds.append(max(bounds[-1] + 1, int(bounds[-1] * BAND_RATIO)))
    return bounds


def allocate(bounds: list[int], sets: dict[int, tuple[int, float]], limit: Threshold) -> list[Band]:
    """Bands with the cheapest allocation. ``sets`` has, by band number, the
    number of sets and their mean size over the whole corpus."""
    bands = []
    for number, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        count, mean = sets.get(number, (0, float(low)))
        needed = max(limit.difference(t) for t in range(2 * high - 6, 2 * high - 1) if t > 0) + 1

        def cost(deletions: int, count: int = count, mean: float = mean, needed: int = needed) -> float:
            segments = needed - deletions
            per = mean / segments
            entries = segments + deletions * per
            meetings = entries * SHARED_SHINGLE**per
            return entries * count + PAIR_COST * RELATED_PAIRS * meetings * count * count / 2

        deletions = min(range(needed // 2 + 1), key=cost)
        reach = limit.smallest_partner(low)
        bands.append(Band(number, low, high, reach, needed - deletions, deletions))
    return bands


def signatures(shingles: np.ndarray, band: Band) -> np.ndarray:
    """Index entries of one set in a band: each segment whole, and of the first
    ``deletions`` segments also all one-deletion neighbours."""
    m = band.segments
    cuts = np.array([(i << 64) // m for i in range(1, m)], dtype=_U64)
    edges = np.concatenate(([0], np.searchsorted(shingles, cuts), [len(shingles)]))
    parts = mix(shingles ^ _U64(0xA5A5A5A5A5A5A5A5))
    sums = np.concatenate((np.zeros(1, dtype=_U64), np.cumsum(parts, dtype=_U64)))
    salts = mix(np.arange(m, dtype=_U64) + _U64(mix_int(band.number + 1)))
    whole = sums[edges[1:]] - sums[edges[:-1]]
    out = [mix(whole + salts)]
    for i in range(band.deletions):
        a, b = edges[i], edges[i + 1]
        out.append(mix(whole[i] - parts[a:b] + salts[i]))
    return np.concatenate(out)


def fingerprint(shingles: np.ndarray) -> int:
    """Identity of a set, together with its size. The high bits grow with the
    size, so that a smallest fingerprint belongs to a smallest set."""
    rank = int(np.log(len(shingles)) / np.log(1.1))
    return (rank << 55) | (mix_int(int(np.sum(mix(shingles + _U64(0x5851F42D4C957F2D)), dtype=_U64))) >> 9)


def parity_sketch(shingles: np.ndarray, limit: Threshold) -> bytes:
    """Parities of the set's counts in 2**k cells. The number of cells in which
    two sets differ never exceeds their symmetric difference, so it rejects pairs
    without error. Halving by XOR gives the sketch with half the cells."""
    cells = 64
    while cells < 4 * limit.difference(2 * len(shingles)):
        cells *= 2
    counts = np.bincount((shingles & _U64(cells - 1)).astype(np.int64), minlength=cells)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def folded(sketch: np.ndarray, width: int) -> np.ndarray:
    """Rows of sketches brought down to ``width`` bytes."""
    while sketch.shape[1] > width:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def _stacked(sketches: list[bytes]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Positions and rows of the sketches by width."""
    widths = np.array([len(s) for s in sketches])
    out = {}
    for w in np.unique(widths):
        at = np.flatnonzero(widths == w)
        rows = np.frombuffer(b"".join(sketches[i] for i in at), dtype=np.uint8).reshape(len(at), int(w))
        out[int(w)] = (at, rows)
    return out


def _difference_limits(totals: np.ndarray, limit: Threshold) -> np.ndarray:
    return totals - 2 * -(-limit.num * totals // (limit.num + limit.den))


def _sets(words: int, limit: Threshold):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            size = np.zeros(len(texts), dtype=np.int32)
            prints = np.zeros(len(texts), dtype=_U64)
            sketches: list[bytes | None] = [None] * len(texts)
            for a, b in chunks(texts):
                for i, s in enumerate(shingle_sets(texts[a:b], words), a):
                    if len(s):
                        size[i], prints[i], sketches[i] = len(s), fingerprint(s), parity_sketch(s, limit)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(size), longs(prints), pa.array(sketches, type=pa.binary())],
                ["doc_id", "n", "print", "sketch"],
            )

    return run


def _entries(words: int, bands: list[Band]):
    """Index entries of the sets of a part; a set that occurs again in the part is
    skipped, so a group of copies sends one set per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in chunks(texts):
                found, sizes, prints = [], [], []
                for s in shingle_sets(texts[a:b], words):
                    n = len(s)
                    key = (n, fingerprint(s)) if n else None
                    if key is None or key in seen:
                        continue
                    seen.add(key)
                    for band in bands:
                        if band.reach <= n < band.high:
                            found.append(signatures(s, band))
                            sizes.append(n)
                            prints.append(key[1])
                if found:
                    lengths = [len(f) for f in found]
                    yield pa.RecordBatch.from_arrays(
                        [
                            longs(np.concatenate(found)),
                            pa.array(np.repeat(np.array(sizes, dtype=np.int32), lengths)),
                            longs(np.repeat(np.array(prints, dtype=_U64), lengths)),
                        ],
                        ["sig", "n", "print"],
                    )

    return run


def _bodies(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in chunks(texts):
                out = [
                    (len(s), fingerprint(s), text)
                    for s, text in zip(shingle_sets(texts[a:b], words), texts[a:b], strict=True)
                    if len(s)
                ]
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([x[0] for x in out], type=pa.int32()),
                            longs(np.array([x[1] for x in out], dtype=_U64)),
                            pa.array([x[2] for x in out], type=pa.binary()),
                        ],
                        ["n", "print", "body"],
                    )

    return run


def _near_by_sketch(limit: Threshold):
    """Of pairs with both sketches, those that their sketches do not reject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = _stacked(batch.column("left_sketch").to_pylist())
            right = _stacked(batch.column("right_sketch").to_pylist())
            total = batch.column("left_n").to_numpy() + batch.column("right_n").to_numpy().astype(np.int64)
            keep = np.zeros(batch.num_rows, dtype=bool)
            for w, (at, rows) in left.items():
                for v, (to, others) in right.items():
                    both, i, j = np.intersect1d(at, to, assume_unique=True, return_indices=True)
                    least = min(w, v)
                    apart = np.bitwise_count(folded(rows[i], least) ^ folded(others[j], least)).sum(1, dtype=np.int64)
                    keep[both] = apart <= _difference_limits(total[both], limit)
            yield batch.select(PAIR).filter(pa.array(keep))

    return run


def _whole_cells(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole cells, and the number of each row's cell. Rows come sorted by
    ``keys``, which name a cell; many small cells come at once."""
    held: list[pa.RecordBatch] = []
    rows = size = 0

    def together() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held)
        named = np.stack([table.column(c).to_numpy().astype(np.int64) for c in keys])
        return table, np.cumsum(np.r_[True, (named[:, 1:] != named[:, :-1]).any(axis=0)])

    for batch in batches:
        if not batch.num_rows:
            continue
        named = [batch.column(c).to_numpy() for c in keys]
        # The last cell of the batch may go on in the next one.
        same = np.logical_and.reduce([k == k[-1] for k in named])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0
        if held and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in keys) and (rows >= CHUNK_ROWS or size >= CELL_BYTES):
            yield together()
            held, rows, size = [], 0, 0
        if cut:
            held.append(batch.slice(0, cut))
            rows += cut
            size += held[-1].nbytes
            if rows >= CHUNK_ROWS or size >= CELL_BYTES:
                yield together()
                held, rows, size = [], 0, 0
        held.append(batch.slice(cut))
        rows += batch.num_rows - cut
        size += held[-1].nbytes
    if held:
        yield together()


def _near_in_buckets(limit: Threshold):
    """All pairs of a bucket that lie in different components and are rejected neither by
    size nor by sketch. Rows come sorted by ``sig``; a bucket has a bounded number of rows,
    and many buckets are compared at once. A bucket with more such pairs than its rows'
    ``most`` is given up: it sends none of them, only its ``crowded`` signature."""

    def pairs(table: pa.Table, cell: np.ndarray, over: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        most_pairs = np.zeros(len(over), dtype=np.int64)
        most_pairs[cell] = table.column("most").to_numpy()
        sent = np.zeros(len(over), dtype=np.int64)
        n = table.column("n").to_numpy().astype(np.int64)
        label = table.column("label").to_numpy()
        width = np.zeros(len(n), dtype=np.int64)
        place = np.zeros(len(n), dtype=np.int64)
        stacks = {}
        for w, (at, rows) in _stacked(table.column("sketch").to_pylist()).items():
            width[at], place[at], stacks[w] = w, np.arange(len(at)), rows
        x = np.arange(len(n))
        for step in range(1, len(n)):
            x = x[x + step < len(n)]
            x = x[(cell[x] == cell[x + step]) & ~over[cell[x]]]
            if not len(x):
                return
            y = x + step
            total = n[x] + n[y]
            near = (label[x] != label[y]) & (np.minimum(n[x], n[y]) * limit.den >= np.maximum(n[x], n[y]) * limit.num)
            i, j, most = x[near], y[near], _difference_limits(total[near], limit)
            for w in stacks:
                for v in stacks:
                    k = np.flatnonzero((width[i] == w) & (width[j] == v))
                    least = min(w, v)
                    for c in range(0, len(k), max(1, 4_000_000 // least)):
                        m = k[c : c + max(1, 4_000_000 // least)]
                        one = folded(stacks[w][place[i[m]]], least)
                        two = folded(stacks[v][place[j[m]]], least)
                        ok = m[np.bitwise_count(one ^ two).sum(1, dtype=np.int64) <= most[m]]
                        if len(ok):
                            sent += np.bincount(cell[i[ok]], minlength=len(over))
                            over |= sent > most_pairs
                            yield i[ok], j[ok]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cell in _whole_cells(batches, ["sig"]):
            node, n, prints = (table.column(c).to_numpy() for c in ("node", "n", "print"))
            over = np.zeros(cell[-1] + 1, dtype=bool)
            # Held until it is known which buckets are given up: at most ``most`` pairs of
            # each and those of its last step.
            held = [(np.where(node[x] > node[y], y, x), np.where(node[x] > node[y], x, y)) for x, y in pairs(table, cell, over)]
            x, y = (np.concatenate([np.zeros(0, dtype=np.int64), *side]) for side in (zip(*held, strict=True) if held else ([], [])))
            sent = ~over[cell[x]]
            x, y = x[sent], y[sent]
            # Once for all buckets in which a pair meets.
            _, first = np.unique(np.stack((node[x], node[y]), 1), axis=0, return_index=True)
            for a in range(0, len(first), CHUNK_ROWS):
                i, j = x[first[a : a + CHUNK_ROWS]], y[first[a : a + CHUNK_ROWS]]
                columns = [n[i], prints[i], node[i], n[j], prints[j], node[j]]
                none = pa.nulls(len(i), pa.int64())
                yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), none], [*PAIR, "crowded"])
            sigs = pa.array(np.unique(table.column("sig").to_numpy()[over[cell]]))
            nothing = [pa.nulls(len(sigs), pa.int32() if c.endswith("_n") else pa.int64()) for c in PAIR]
            yield pa.RecordBatch.from_arrays([*nothing, sigs], [*PAIR, "crowded"])

    return run


def joins(sets: list[np.ndarray], labels: np.ndarray, limit: Threshold) -> list[tuple[int, int]]:
    """Links that connect all sets which links among them connect, where sets of one
    label are connected to begin with: at most one less than there are labels.

    From each component found so far the search goes on through the sets it reached,
    each of which is compared exactly with those that no component holds yet."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate(([0], np.cumsum(sizes)))
    mark = np.zeros(len(values), dtype=bool)
    left = np.ones(len(sets), dtype=bool)
    rows, row_ids, row_starts = np.arange(len(sets)), ids, starts[:-1]
    found = []

    def reached(y: int) -> list[int]:
        mates = np.flatnonzero(left & (labels == labels[y]))
        left[mates] = False
        return mates.tolist()

    for first in range(len(sets)):
        if not left[first]:
            continue
        queue = reached(first)
        while queue and left.any():
            x = queue.pop()
            still = left[rows]
            if np.count_nonzero(still) < 0.75 * len(rows):
                row_ids, rows = row_ids[np.repeat(still, sizes[rows])], rows[still]
                row_starts = np.concatenate(([0], np.cumsum(sizes[rows])[:-1]))
            own = ids[starts[x] : starts[x + 1]]
            mark[own] = True
            both = np.add.reduceat(mark[row_ids], row_starts, dtype=np.int64)
            mark[own] = False
            near = left[rows] & (limit.den * both >= limit.num * (sizes[x] + sizes[rows] - both))
            for y in rows[near].tolist():
                if left[y]:
                    found.append((x, y))
                    queue.extend(reached(y))
    return found


def _joined_in_cells(limit: Threshold):
    """Links that join the components of each cell, by the shingles its rows carry.
    Rows come sorted by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, cell in _whole_cells(batches, ["sig", "c1", "c2"]):
            node, label = (table.column(c).to_numpy() for c in ("node", "label"))
            sets = [np.frombuffer(s, dtype=_U64) for s in table.column("shingles").to_pylist()]
            edges = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1], True])
            one, two = [], []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if (label[a:b] != label[a]).any():
                    for x, y in joins(sets[a:b], label[a:b], limit):
                        one.append(node[a + x])
                        two.append(node[a + y])
            yield pa.RecordBatch.from_arrays(
                [pa.array(one, type=pa.int64()), pa.array(two, type=pa.int64())], ["left_node", "right_node"]
            )

    return run


def _carried(words: int):
    """The shingle hashes of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            for a, b in chunks(texts):
                found = [s for s in shingle_sets(texts[a:b], words) if len(s)]
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([len(s) for s in found], type=pa.int32()),
                            longs(np.array([fingerprint(s) for s in found], dtype=_U64)),
                            pa.array([s.tobytes() for s in found], type=pa.binary()),
                        ],
                        ["n", "print", "shingles"],
                    )

    return run


def _linked(words: int, limit: Threshold):
    """Of pairs with both texts, those whose shingle sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = batch.column("left_body").to_pylist()
            right = batch.column("right_body").to_pylist()
            keep = np.zeros(len(left), dtype=bool)
            for a, b in chunks(left):
                for c, d in chunks(right[a:b]):
                    one = shingle_sets(left[a + c : a + d], words)
                    two = shingle_sets(right[a + c : a + d], words)
                    for i, (s, t) in enumerate(zip(one, two, strict=True), a + c):
                        both = len(np.intersect1d(s, t, assume_unique=True))
                        keep[i] = limit.den * both >= limit.num * (len(s) + len(t) - both)
            yield batch.select(["left_node", "right_node"]).filter(pa.array(keep))

    return run


PAIR = ["left_n", "left_print", "left_node", "right_n", "right_print", "right_node"]
_PAIR_TYPES = "left_n int, left_print long, left_node long, right_n int, right_print long, right_node long"
# Buckets up to this many rows send their pairs, which are verified once however
# many buckets they meet in. Larger ones do so while the pairs that their sketches leave
# are no more than PAIRS_A_ROW for each row, or half of PAIRED_ROWS where all their pairs,
# of PAIR_BYTES, weigh no more than the shingles of their sets; else the shingles are sent
# instead of pairs. So the pairs grow with the rows, not with the square of a group.
PAIRED_ROWS = 16
PAIR_BYTES = 48
PAIRS_A_ROW = 4
# Rows, and bytes of shingles, of a larger bucket that one task takes at once. Beyond
# that a bucket is cut into slices, and every two slices that are not joined already
# meet in one cell.
CELL_ROWS = 2_048
CELL_BYTES = 32_000_000
# Rows of many cells taken at once.
CHUNK_ROWS = 50_000


def _side(ids: DataFrame, side: str, *columns: str) -> DataFrame:
    return ids.select(*(F.col(c).alias(f"{side}_{c}") for c in columns))


def _verify(pairs: DataFrame, docs: DataFrame, words: int, limit: Threshold) -> DataFrame:
    """Links (left_node, right_node) among the pairs, by the shingle sets of the
    whole texts."""
    pairs = written(pairs, "ngram-pairs")
    involved = written(pairs.select(F.explode(F.array("left_node", "right_node")).alias("doc_id")).distinct(), "ngram-ids")
    bodies = docs.join(involved, "doc_id", "left_semi").select("text").mapInArrow(_bodies(words), "n int, print long, body binary")
    together = pairs.join(_side(bodies, "left", "n", "print", "body"), ["left_n", "left_print"]).join(
        _side(bodies, "right", "n", "print", "body"), ["right_n", "right_print"]
    )
    return written(together.mapInArrow(_linked(words, limit), "left_node long, right_node long"), "ngram-links")


def _most_pairs():
    """How many pairs a bucket of ``rows`` sets with ``held`` shingles may send: no more for
    each row than a bucket of PAIRED_ROWS rows has, however large it is. Null for buckets
    that are too large to be compared by sketches in one task."""
    lighter = F.col("rows") * F.col("rows") * PAIR_BYTES <= F.col("held") * 16
    few = (F.col("rows") <= PAIRED_ROWS) | lighter
    most = F.when(few, F.col("rows") * PAIRED_ROWS / 2).otherwise(F.col("rows") * PAIRS_A_ROW)
    return F.when(F.col("rows") <= CELL_ROWS, most.cast("long"))


def _open_buckets(shared: DataFrame, ids: DataFrame, first: DataFrame) -> DataFrame:
    """The sets of all buckets that hold several components, with the most pairs that the
    bucket may send, its slices and the slice of each set. A slice has a bounded number of rows and bytes."""
    placed = ids.join(first, "node", "left").withColumn("label", F.coalesce("component", "node")).drop("component")
    mixed = (
        shared.join(placed.select("n", "print", "label"), ["n", "print"])
        .groupBy("sig")
        .agg(F.min("label").alias("a"), F.max("label").alias("b"), F.count("*").alias("rows"), F.sum("n").alias("held"))
        .where("a <> b")
        .select(
            "sig",
            _most_pairs().alias("most"),
            F.greatest(F.ceil(F.col("rows") / CELL_ROWS), F.ceil(F.col("held") * 8 / CELL_BYTES)).cast("int").alias("slices"),
        )
    )
    return (
        shared.select("sig", "n", "print")
        .distinct()
        .join(mixed, "sig")
        .join(placed, ["n", "print"])
        .withColumn("slice", F.pmod(F.xxhash64("print", "n"), F.col("slices")).cast("int"))
    )


def _join_cells(cells: DataFrame, carried: DataFrame, limit: Threshold) -> DataFrame:
    """Links (left_node, right_node) that join the components of each cell."""
    together = cells.select("sig", "c1", "c2", "n", "print", "node", "label").join(carried, ["n", "print"])
    return written(
        together.select("sig", "c1", "c2", "node", "label", "shingles")
        .repartition("sig", "c1", "c2")
        .sortWithinPartitions("sig", "c1", "c2")
        .mapInArrow(_joined_in_cells(limit), "left_node long, right_node long")
        .distinct(),
        "ngram-joins",
    )


def near_groups(docs: DataFrame, *, words: int, num: int, den: int) -> DataFrame:
    """Groups of documents linked by Jaccard similarity of at least num/den on
    distinct shingles of ``words`` words, words being runs of bytes other than
    0x20 and 0x09-0x0D with A-Z in lower case.

    One row per row of ``docs`` with ``doc_id``, ``n_shingles`` and
    ``component_id``, the smallest doc_id reachable by links, itself included.
    A text of fewer words is one shingle; null, empty or blank text has none and
    links with nothing, so its component is its own doc_id. Rows without doc_id
    link with nothing and have a null component. Repeated rows stay. Other columns
    are not read.
    """
    limit = Threshold(num, den)
    texts = docs.select("doc_id", "text")
    sets = written(texts.mapInArrow(_sets(words, limit), "doc_id long, n int, print long, sketch binary"), "ngram-sets")
    known = sets.where(F.col("doc_id").isNotNull() & (F.col("n") > 0))
    ids = written(
        known.groupBy("n", "print").agg(F.min("doc_id").alias("node"), F.any_value("sketch").alias("sketch")), "ngram-ids"
    )

    largest = known.agg(F.max("n")).first()[0] or 0
    bounds = size_bounds(largest)
    number = sum((F.col("n") >= b).cast("int") for b in bounds[1:]) if len(bounds) > 1 else F.lit(0)
    # One row per band: the bands grow with the logarithm of the largest size.
    stats = ids.groupBy(number.alias("band")).agg(F.count("*").alias("sets"), F.avg("n").alias("mean")).collect()
    bands = allocate(bounds, {r["band"]: (r["sets"], r["mean"]) for r in stats}, limit)

    known_texts = texts.where(F.col("doc_id").isNotNull())
    entries = (
        known_texts.select("text").mapInArrow(_entries(words, bands), "sig long, n int, print long").repartition("sig")
    )
    # The count of n keeps this branch on the same exchange as the join below.
    buckets = (
        entries.groupBy("sig")
        .agg(F.min("print").alias("lo"), F.max("print").alias("hi"), F.count("n").alias("rows"))
        .where("lo <> hi")
    )
    # Entries of signatures that more than one set has.
    shared = written(entries.join(buckets.hint("shuffle_hash"), "sig"), "ngram-shared")

    def fits(a: str, b: str):
        return F.least(a, b) * F.lit(den) >= F.greatest(a, b) * F.lit(num)

    # First the pairs with the smallest and the largest set of each bucket.
    ends = shared.select("print", "n", F.explode(F.array("lo", "hi")).alias("left_print")).distinct()
    stars = (
        ends.join(_side(ids, "left", "n", "print", "node", "sketch"), "left_print")
        .where(fits("left_n", "n"))
        .join(ids, ["n", "print"])
        .where(F.col("node") != F.col("left_node"))
        .select("left_n", "left_print", "left_node", "left_sketch", *(F.col(c).alias(f"right_{c}") for c in ids.columns))
        .mapInArrow(_near_by_sketch(limit), _PAIR_TYPES)
    )
    # Of a set's many stars two are enough to hang it on its component.
    least, greatest = (f(F.struct("left_print", "left_n", "left_node")) for f in (F.min, F.max))
    hung = (
        stars.groupBy("right_n", "right_print", "right_node")
        .agg(F.array(least, greatest).alias("ends"))
        .select("right_n", "right_print", "right_node", F.explode("ends").alias("end"))
        .select("end.*", "right_n", "right_print", "right_node")
        .select(*PAIR)
        .distinct()
    )
    links = _verify(hung, texts, words, limit)
    first = components(links, "left_node", "right_node")

    # Then the buckets that still hold several components, by pairs or by shingles.
    buckets = written(_open_buckets(shared, ids, first), "ngram-open")
    small = buckets.where("most is not null").select("sig", "n", "print", "node", "label", "sketch", "most")
    near = written(
        small.repartition("sig")
        .sortWithinPartitions("sig")
        .mapInArrow(_near_in_buckets(limit), f"{_PAIR_TYPES}, crowded long")
        .distinct(),
        "ngram-near",
    )
    links = links.unionByName(_verify(near.where("crowded is null").select(*PAIR), texts, words, limit))

    # Of the others, those that hold several components still.
    second = components(links, "left_node", "right_node")
    crowded = near.where("crowded is not null").select(F.col("crowded").alias("sig"))
    large = buckets.where("most is null").unionByName(buckets.join(crowded, "sig", "left_semi"))
    large = large.drop("label").join(second, "node", "left").withColumn("label", F.coalesce("component", "node"))
    mixed = large.groupBy("sig").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("sig")
    large = written(
        large.join(mixed, "sig", "left_semi").select("sig", "n", "print", "node", "label", "slice", "slices"), "ngram-large"
    )
    owners = written(large.select(F.col("node").alias("doc_id")).distinct(), "ngram-owners")
    carried = written(
        texts.join(owners, "doc_id", "left_semi")
        .select("text")
        .mapInArrow(_carried(words), "n int, print long, shingles binary")
        .groupBy("n", "print")
        .agg(F.any_value("shingles").alias("shingles")),
        "ngram-shingles",
    )
    links = links.unionByName(_join_cells(large.withColumn("c1", F.col("slice")).withColumn("c2", F.col("slice")), carried, limit))
    found = components(links, "left_node", "right_node")

    # Slices of one bucket, where it is not one component by now.
    sliced = large.where("slices > 1").drop("label").join(found, "node", "left")
    sliced = sliced.withColumn("label", F.coalesce("component", "node")).drop("component")
    apart = sliced.groupBy("sig").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("sig")
    across = written(sliced.join(apart, "sig", "left_semi"), "ngram-across")
    if not across.isEmpty():
        # Every two slices meet in one cell; a row goes to one cell for each other slice.
        cells = (
            across.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
            .where("other <> slice")
            .withColumn("c1", F.least("slice", "other"))
            .withColumn("c2", F.greatest("slice", "other"))
        )
        links = links.unionByName(_join_cells(cells, carried, limit))
        found = components(links, "left_node", "right_node")

    groups = ids.join(found, "node", "left").select("n", "print", F.coalesce("component", "node").alias("component_id"))
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    return sets.join(groups, ["n", "print"], "left").select(
        "doc_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.when(linked, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
