"""Mining of hard negatives with angular triangle filtering.

Each vector keeps its angles to a few reference directions. If an anchor has angle s to
a reference and a row has angle t, the angle between them lies between |s - t| and s + t,
so its cosine lies between cos s cos t - sin s sin t and cos s cos t + sin s sin t. The
narrowest such interval, times both norms and widened by more than rounding can take
away, bounds the integer inner product. Only rows whose bounds overlap the scores that
an anchor asks for are scored, and the scores are exact.

Rows lie in blocks: those nearest to one reference, cut into bands of the angle to it,
and a band into parts of bounded size. The bounds hold for whole bands as well, so an
anchor travels to the blocks that can answer it, and rows are dealt to blocks once a pass.
A task holds one block at a time while its anchors stream by. Passes: anchors ask the
blocks around their own reference, which tells how good a positive must be; then the
others for better ones; then all for rows in the windows below their positives.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.scratch import written

# Rows that the reference directions are learned from.
FIT_ROWS = 8_192
FIT_STEPS = 10
REFERENCES = 16
# Rows of a block, and the most bands of one reference; a fuller band has parts.
BLOCK_ROWS = 16_384
BANDS = 64
ANCHORS_AT_ONCE = 64
# Far more than the rounding of cosines and angles, as a share of both norms.
MARGIN = 1e-7
# Norms below this keep every sum within 64 bits.
MOST_NORM = 2.0**31
# Below this, products and sums of doubles are exact.
_EXACT = 2.0**53
_NEVER = 2**62

_ROW = "row long, vec_id long, label long, q array<int>, norm double, home int, angles array<double>"
_ASKS = "array<struct<row: bigint, vec_id: bigint, score: bigint>>"


@dataclass(frozen=True)
class Question:
    """What counts: ``top`` best, a row's score at least ``num`` in ``den`` of its positive's."""

    top: int
    num: int
    den: int


@dataclass(frozen=True)
class Bands:
    """What is known of each band, and the number of its first block."""

    reference: np.ndarray
    angle: np.ndarray
    norm: np.ndarray
    parts: np.ndarray
    base: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        object.__setattr__(self, "base", np.cumsum(self.parts) - self.parts)

    def bounds(self, norms: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score that each vector can have with a row of each band."""
        own = angles[:, self.reference]
        near = np.maximum(0.0, np.maximum(own - self.angle[:, 1], self.angle[:, 0] - own))
        far = np.minimum(np.pi, np.minimum(own + self.angle[:, 1], 2 * np.pi - own - self.angle[:, 0]))
        best, worst = np.cos(near), np.cos(np.maximum(near, far))
        longest = norms[:, None] * self.norm[:, 1]
        shortest = norms[:, None] * self.norm[:, 0]
        slack = MARGIN * longest + 1
        return (
            np.where(worst < 0, longest, shortest) * worst - slack,
            np.where(best < 0, shortest, longest) * best + slack,
        )


def learn(sample: np.ndarray, references: int = REFERENCES) -> np.ndarray:
    """Unit directions in the middle of the sample's clusters (spherical k-means)."""
    norms = np.sqrt((sample**2).sum(1))
    unit = sample[norms > 0] / norms[norms > 0][:, None]
    if not len(unit):
        return np.eye(1, sample.shape[1])
    distinct = np.unique(unit, axis=0)
    random = np.random.default_rng(0)
    found = distinct[random.permutation(len(distinct))[:references]]
    for _ in range(FIT_STEPS):
        home = (unit @ found.T).argmax(1)
        for i in range(len(found)):
            middle = unit[home == i].sum(0)
            length = np.sqrt((middle**2).sum())
            if length > 1e-9:
                found[i] = middle / length
    return found


def usable(vectors: DataFrame, flip: tuple[int, int, int]) -> DataFrame:
    """row, vec_id, label and the vector as integers ``q``. (every, plus, of): where
    ``every`` divides vec_id, the label is (label + plus) % of."""
    every, plus, of = flip
    label = F.col("label").cast("long")
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    there = vectors.where("vec_id is not null and label is not null and embedding is not null").where(finite)
    scaled = there.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % every == 0, (label + plus) % of).otherwise(label).alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("q"),
    )
    square = F.aggregate("q", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return scaled.where((F.size("q") > 0) & (square < MOST_NORM**2)).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "label", F.col("q").cast("array<int>").alias("q")
    )


def _matrix(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return values.reshape(len(flat), -1)


def _lists(values: np.ndarray) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel()))


def _angled(directions: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            q = _matrix(batch.column("q"), np.float64)
            norms = np.sqrt((q**2).sum(1))
            cosines = q @ directions.T / np.where(norms > 0, norms, 1)[:, None]
            angles = np.arccos(np.clip(cosines, -1, 1))
            home = angles.argmin(1)
            columns = [
                *batch.columns,
                pa.array(norms),
                pa.array(home.astype(np.int32)),
                _lists(angles),
                pa.array(angles[np.arange(len(home)), home]),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "norm", "home", "angles", "angle"])

    return run


def _laid_out(angled: DataFrame) -> tuple[DataFrame, Bands]:
    """``angled`` with the block of each row, and the bands."""
    spark = angled.sparkSession
    shares = [i / BANDS for i in range(1, BANDS)]
    # One row per reference.
    cells = angled.groupBy("home").agg(F.count("*").alias("n"), F.percentile_approx("angle", shares, 1_000).alias("cuts")).collect()
    edges = []
    for cell in cells:
        bands = min(BANDS, -(-cell["n"] // BLOCK_ROWS))
        edges.append((cell["home"], sorted({cell["cuts"][i * BANDS // bands - 1] for i in range(1, bands)})))
    known = F.broadcast(spark.createDataFrame(edges, "home int, edges array<double>"))
    banded = angled.join(known, "home").withColumn(
        "band", F.size(F.filter("edges", lambda e: e < F.col("angle"))).cast("int")
    )
    # At most ``BANDS`` rows per reference.
    found = (
        banded.groupBy("home", "band")
        .agg(
            F.count("*").alias("n"),
            F.min("angle").alias("near"),
            F.max("angle").alias("far"),
            F.min("norm").alias("short"),
            F.max("norm").alias("long"),
        )
        .orderBy("home", "band")
        .collect()
    )
    bands = Bands(
        np.array([r["home"] for r in found]),
        np.array([(r["near"], r["far"]) for r in found]),
        np.array([(r["short"], r["long"]) for r in found]),
        np.array([-(-r["n"] // BLOCK_ROWS) for r in found]),
    )
    places = [(r["home"], r["band"], int(p), int(b)) for r, p, b in zip(found, bands.parts, bands.base, strict=True)]
    known = F.broadcast(spark.createDataFrame(places, "home int, band int, parts int, base int"))
    block = (F.col("base") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int")
    return banded.join(known, ["home", "band"]).withColumn("block", block), bands


def _visits(bands: Bands, home: bool | None):
    """Adds the blocks where an anchor can find scores from ``low`` to ``high``: those
    around its own reference, those around others, or (None) all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            norms = batch.column("norm").to_numpy()
            least, most = bands.bounds(norms, _matrix(batch.column("angles"), np.float64))
            low, high = (batch.column(c).to_numpy()[:, None] for c in ("low", "high"))
            meets = (most >= low) & (least <= high)
            if home is not None:
                own = batch.column("home").to_numpy()[:, None] == bands.reference
                meets &= own if home else ~own
            blocks = [
                [int(b) for i in np.flatnonzero(m) for b in range(bands.base[i], bands.base[i] + bands.parts[i])] for m in meets
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(blocks, type=pa.list_(pa.int32()))], [*batch.schema.names, "blocks"]
            )

    return run


class Block:
    """Rows of one block, and their answers."""

    def __init__(self, table: pa.Table) -> None:
        self.row = table["row"].to_numpy()
        self.vec_id = table["vec_id"].to_numpy()
        self.label = table["label"].to_numpy()
        self.norm = table["norm"].to_numpy()
        self.q = _matrix(table["q"], np.float64)
        angles = _matrix(table["angles"], np.float64)
        self.home = int(table["home"][0].as_py())
        self._cos, self._sin = np.cos(angles), np.sin(angles)

    def bounds(self, norms: np.ndarray, angles: np.ndarray, homes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest score of each anchor with each row, by the block's own
        reference and by each anchor's."""
        cos, sin = np.cos(angles), np.sin(angles)
        both = np.outer(cos[:, self.home], self._cos[:, self.home])
        swing = np.outer(sin[:, self.home], self._sin[:, self.home])
        low, high = both - swing, both + swing
        each = np.arange(len(homes)), homes
        both = cos[each][:, None] * self._cos[:, homes].T
        swing = sin[each][:, None] * self._sin[:, homes].T
        np.maximum(low, both - swing, out=low)
        np.minimum(high, both + swing, out=high)
        product = np.outer(norms, self.norm)
        slack = MARGIN * product + 1
        return low * product - slack, high * product + slack

    def scores(self, anchors: np.ndarray, norms: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of rows that some anchor wants; others are never met."""
        out = np.full(wanted.shape, -_NEVER, dtype=np.int64)
        rows = np.flatnonzero(wanted.any(0))
        if len(rows):
            if norms.max() * self.norm[rows].max() < _EXACT:
                found = (anchors @ self.q[rows].T).astype(np.int64)
            else:
                found = anchors.astype(np.int64) @ self.q[rows].astype(np.int64).T
            out[:, rows] = found
        return out

    def first(self, scores: np.ndarray, rows: np.ndarray, top: int) -> np.ndarray:
        """The ``top`` best of ``rows``, ties by vec_id."""
        if len(rows) > top:
            least = np.partition(scores[rows], len(rows) - top)[len(rows) - top]
            rows = rows[scores[rows] >= least]
        return rows[np.lexsort((self.vec_id[rows], -scores[rows]))[:top]]


def _positives(block: Block, batch: dict[str, np.ndarray], ask: Question) -> Iterator[tuple]:
    """(anchor, its id, row, its id, score) of the best rows of the anchors' labels."""
    norms, angles, homes = batch["norm"], batch["angles"], batch["home"]
    _, high = block.bounds(norms, angles, homes)
    same = (block.label == batch["label"][:, None]) & (block.row != batch["row"][:, None])
    least = batch["low"].copy()
    # A few rows of the greatest bounds tell how good the others must be.
    reach = np.where(same, high, -np.inf)
    tried = min(4 * ask.top, reach.shape[1])
    at = np.argpartition(-reach, tried - 1, axis=1)[:, :tried]
    trial = np.zeros_like(same)
    np.put_along_axis(trial, at, True, axis=1)
    scores = block.scores(batch["q"], norms, trial & same)
    for i in range(len(least)):
        met = np.sort(scores[i, at[i]][same[i, at[i]]])[::-1]
        if len(met) >= ask.top:
            least[i] = max(least[i], float(met[ask.top - 1]))
    wanted = same & (high >= least[:, None])
    scores = block.scores(batch["q"], norms, wanted)
    for i in range(len(least)):
        for r in block.first(scores[i], np.flatnonzero(wanted[i]), ask.top):
            yield batch["row"][i], batch["vec_id"][i], block.row[r], block.vec_id[r], scores[i, r]


def _negatives(block: Block, batch: dict[str, np.ndarray], ask: Question) -> Iterator[tuple]:
    """(anchor's id, anchor, positive, its id, its score, row's id, score) of rows of other
    labels in the windows below the positives."""
    norms = batch["norm"]
    low, high = block.bounds(norms, batch["angles"], batch["home"])
    wanted = (block.label != batch["label"][:, None]) & (high >= batch["low"][:, None]) & (low <= batch["high"][:, None])
    scores = block.scores(batch["q"], norms, wanted)
    for i, positives in enumerate(batch["asks"]):
        rows = np.flatnonzero(wanted[i])
        met = scores[i, rows]
        for p in positives:
            # In Python's integers: the products may not fit 64 bits.
            least = -(-ask.num * p["score"] // ask.den)
            within = rows[(met <= p["score"]) & (met >= least)]
            for r in block.first(scores[i], within, ask.top):
                yield batch["vec_id"][i], batch["row"][i], p["row"], p["vec_id"], p["score"], block.vec_id[r], scores[i, r]


def _answered(answer, ask: Question, names: list[str]):
    """Answers of a stream sorted by block, with a block's rows before its anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block, held = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            blocks, kinds = (table[c].to_numpy() for c in ("block", "kind"))
            turns = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
            for start, end in zip([0, *turns], [*turns, len(blocks)], strict=True):
                part = table.slice(start, end - start)
                if blocks[start] != name:
                    name, block, held = blocks[start], None, []
                if kinds[start] == 0:
                    held.append(part.combine_chunks())
                    continue
                if block is None:
                    if not held:
                        continue
                    block, held = Block(pa.concat_tables(held)), []
                found: list[tuple] = []
                for at in range(0, part.num_rows, ANCHORS_AT_ONCE):
                    some = part.slice(at, ANCHORS_AT_ONCE)
                    asked = {c: some[c].to_numpy() for c in ("row", "vec_id", "label", "norm", "home", "low", "high")}
                    asked["q"] = _matrix(some["q"], np.float64)
                    asked["angles"] = _matrix(some["angles"], np.float64)
                    asked["asks"] = some["asks"].to_pylist()
                    found.extend(answer(block, asked, ask))
                columns = list(zip(*found, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(map(int, c), type=pa.int64()) for c in columns], names)

    return run


def _asked(rows: DataFrame, bands: Bands, anchors: DataFrame, home: bool | None, answer, ask: Question, names: list[str]) -> DataFrame:
    """Answers of ``rows`` to ``anchors``, which have low, high and asks."""
    columns = [c.split()[0] for c in _ROW.split(", ")]
    visiting = anchors.select(*columns, "low", "high", "asks").mapInArrow(
        _visits(bands, home), f"{_ROW}, low double, high double, asks {_ASKS}, blocks array<int>"
    )
    visiting = visiting.select("*", F.explode("blocks").alias("block")).drop("blocks")
    stream = (
        rows.select(*columns, "block", F.lit(0).alias("kind"))
        .unionByName(visiting.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        .repartition("block")
        .sortWithinPartitions("block", "kind", "home")
    )
    return stream.mapInArrow(_answered(answer, ask, names), ", ".join(f"{n} long" for n in names))


def _best(found: DataFrame, group: list[str], score: str, name: str, top: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.desc(score), name)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def mined(
    vectors: DataFrame,
    *,
    every: int,
    top: int = 5,
    least: tuple[int, int] = (80, 100),
    flip: tuple[int, int, int] = (7, 1, 10),
) -> DataFrame:
    """For each row of ``vectors`` (vec_id, embedding, label) whose vec_id ``every`` divides and
    each of its ``top`` best other rows of its label, the positives, the ``top`` best rows
    of other labels that score at most the positive's score and at least ``least`` (a
    fraction) of it: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.

    A score is the inner product with the anchor of the vectors' components times 256,
    rounded down; ties go to the smaller vec_id. See ``usable`` for ``flip``. Rows take no
    part whose vec_id, label or vector is null, or whose vector has a null or non-finite
    component, is empty, is not as long as most (of lengths as frequent, the least), or has
    components so large (a norm of 2**23) that a score would not fit 64 bits. Zero vectors
    take part. Rows that share a vec_id are different rows, as anchors too: their answers
    then repeat. An empty table gives no rows."""
    kinds = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = usable(vectors, flip)
    size = rows.groupBy(F.size("q").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if size is None:
        return vectors.sparkSession.createDataFrame([], kinds)
    rows = rows.where(F.size("q") == size["size"])
    sample = rows.orderBy(F.xxhash64("vec_id"), "row").limit(FIT_ROWS).select("q").collect()
    directions = learn(np.array([r["q"] for r in sample], dtype=np.float64))
    angled = written(
        rows.mapInArrow(_angled(directions), f"{_ROW}, angle double"), "angles"
    )
    placed, bands = _laid_out(angled)
    ask = Question(top, *least)

    no_asks: Column = F.array().cast(_ASKS)
    far = {"low": F.lit(float(-_NEVER)), "high": F.lit(float(_NEVER)), "asks": no_asks}
    anchors = angled.where(F.col("vec_id") % every == 0).drop("angle")
    names = ["anchor", "anchor_id", "positive", "positive_id", "score"]
    around = written(
        _best(_asked(placed, bands, anchors.withColumns(far), True, _positives, ask, names), ["anchor"], "score", "positive_id", top),
        "near-positives",
    )
    enough = around.where(F.col("rank") == top).select(F.col("anchor").alias("row"), F.col("score").cast("double").alias("_least"))
    known = anchors.join(enough, "row", "left").withColumns(far | {"low": F.coalesce("_least", far["low"])})
    elsewhere = _asked(placed, bands, known.drop("_least"), False, _positives, ask, names)
    positives = written(
        _best(around.drop("rank").unionByName(elsewhere), ["anchor"], "score", "positive_id", top), "positives"
    )
    # At most ``top`` to an anchor. Below zero the window is empty.
    listed = (
        positives.where(F.col("score") >= 0)
        .groupBy(F.col("anchor").alias("row"))
        .agg(F.collect_list(F.struct(F.col("positive").alias("row"), F.col("positive_id").alias("vec_id"), "score")).alias("asks"))
        .withColumns(
            {
                "low": F.array_min("asks.score").cast("double") * (least[0] / least[1]) - 1,
                "high": F.array_max("asks.score").cast("double"),
            }
        )
    )
    names = ["anchor_id", "anchor", "positive", "positive_id", "positive_score", "negative_id", "negative_score"]
    found = _asked(placed, bands, anchors.join(listed, "row"), None, _negatives, ask, names)
    best = _best(found, ["anchor", "positive"], "negative_score", "negative_id", top)
    return best.select("anchor_id", "positive_id", F.col("rank").cast("int"), "negative_id", "positive_score", "negative_score")
