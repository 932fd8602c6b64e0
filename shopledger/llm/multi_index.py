"""Nearest neighbours by inner product with multi-index hashing.

Vectors become binary codes: the signs of several learned rotations of their
principal axes. Each code is cut into bytes, and each byte has an index from value to
rows. By the pigeonhole principle a code within Hamming radius R of the query is
within R_i of it in some byte i whenever the sum of (R_i + 1) exceeds R, so probing
all byte values within R_i in every index retrieves every code within R. Those codes
are reranked by the exact inner product. A query that finds too few widens R.

Rows are dealt into blocks of bounded size, and each block of queries meets each
block of rows once; only the nearest of each meeting travel on.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopledger.llm.scratch import written

# Vectors that the rotations and the radius are learned from.
FIT_ROWS = 8_192
FIT_QUERIES = 400
CODE_BITS = 256
ROTATION_STEPS = 30
# Share of the sample's true neighbours that lie within the radius.
WITHIN = 0.985
ROW_BLOCK = 8_192
QUERY_BLOCK = 2_048

_NEAR = [np.bitwise_count(np.arange(256, dtype=np.uint8)[:, None] ^ np.arange(256, dtype=np.uint8)[None, :])]


@dataclass(frozen=True)
class Codes:
    """Longest vector, mean and axes, and the rotations of the axes."""

    longest: float
    mean: np.ndarray
    turned: np.ndarray
    radius: int

    def _coded(self, lifted: np.ndarray) -> np.ndarray:
        return np.packbits((lifted - self.mean) @ self.turned > 0, axis=1)

    def rows(self, vectors: np.ndarray) -> np.ndarray:
        """Codes of rows. One more coordinate brings all to one length, so that the
        nearest by angle is the nearest by inner product."""
        scaled = vectors / self.longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(1)))
        return self._coded(np.c_[scaled, rest])

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / np.sqrt((vectors**2).sum(1))[:, None]
        return self._coded(np.c_[scaled, np.zeros(len(scaled))])


def learn(sample: np.ndarray, longest: float, top: int) -> Codes:
    """Rotations that bring the sample's axes close to their signs (iterative
    quantisation), from several starts, and the radius that holds its neighbours."""
    scaled = sample / longest
    lifted = np.c_[scaled, np.sqrt(np.maximum(0.0, 1.0 - (scaled**2).sum(1)))]
    mean = lifted.mean(0)
    _, axes = np.linalg.eigh((lifted - mean).T @ (lifted - mean))
    bits = min(lifted.shape[1], CODE_BITS) // 8 * 8 or lifted.shape[1]
    axes = axes[:, ::-1][:, :bits]
    flat = (lifted - mean) @ axes
    random = np.random.default_rng(0)
    turned = []
    for _ in range(-(-CODE_BITS // bits)):
        turn = np.linalg.qr(random.normal(size=(bits, bits)))[0]
        for _ in range(ROTATION_STEPS):
            left, _, right = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
            turn = (left @ right).T
        turned.append(axes @ turn)
    codes = Codes(longest, mean, np.concatenate(turned, 1), 0)
    asked = sample[:FIT_QUERIES]
    scores = asked @ sample.T
    np.fill_diagonal(scores, -np.inf)
    nearest = np.argsort(-scores, axis=1)[:, : min(top, max(1, len(sample) - 1))]
    apart = np.bitwise_count(codes.queries(asked)[:, None, :] ^ codes.rows(sample)[nearest]).sum(2)
    return Codes(longest, mean, codes.turned, int(np.quantile(apart, WITHIN)))


class Index:
    """One index per byte of the codes of a block."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        self._order = [np.argsort(c, kind="stable") for c in codes.T]
        self._starts = [np.searchsorted(c[o], np.arange(257)) for c, o in zip(codes.T, self._order, strict=True)]
        self._probed: dict[tuple[int, int, int], np.ndarray] = {}

    def _probe(self, byte: int, value: int, radius: int) -> np.ndarray:
        """Rows whose byte is within the radius of the value."""
        key = byte, value, radius
        if key not in self._probed:
            starts, order = self._starts[byte], self._order[byte]
            near = np.flatnonzero(_NEAR[0][value] <= radius)
            self._probed[key] = np.concatenate([order[starts[v] : starts[v + 1]] for v in near])
        return self._probed[key]

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """All rows with a code within the radius."""
        parts = len(code)
        each, wider = divmod(radius + 1, parts)
        met = np.zeros(len(self.codes), dtype=bool)
        for i, value in enumerate(code.tolist()):
            # The first ``wider`` bytes allow one difference more.
            allowed = each if i < wider else each - 1
            if allowed >= 0:
                met[self._probe(i, value, min(allowed, 8))] = True
        rows = np.flatnonzero(met)
        return rows[np.bitwise_count(self.codes[rows] ^ code).sum(1, dtype=np.int64) <= radius]


def _nearest(model: Codes, top: int):
    kinds = ["query_id", "vec_id", "score"]

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        asks = table.column("asks").to_numpy()
        vectors = np.array(table.column("vector").to_pylist(), dtype=np.float64)
        row_ids, rows = ids[~asks], vectors[~asks]
        query_ids, queries = ids[asks], vectors[asks]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(rows) and len(queries):
            index = Index(model.rows(rows))
            for name, query, code in zip(query_ids, queries, model.queries(queries), strict=True):
                radius, bits = model.radius, 8 * len(code)
                others = int((row_ids != name).sum())
                while True:
                    near = index.within(code, radius)
                    near = near[row_ids[near] != name]
                    if len(near) >= min(top, others) or radius >= bits:
                        break
                    radius = min(bits, radius + max(1, bits // 32))
                scores = (rows[near] * query).sum(1)
                best = np.lexsort((row_ids[near], -scores))[:top]
                found.append((np.full(len(best), name), row_ids[near][best], scores[best]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] if found else [[], [], []]
        types = [pa.int64(), pa.int64(), pa.float64()]
        return pa.table([pa.array(c, type=t) for c, t in zip(columns, types, strict=True)], names=kinds)

    return run


def _usable(vectors: DataFrame) -> DataFrame:
    """vec_id and vector, one row per vec_id; of several vectors the least stands."""
    finite = ~F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.where("vec_id is not null and embedding is not null").where(finite & some)
    return rows.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(
        F.min(F.col("embedding").cast("array<double>")).alias("vector")
    )


def nearest(vectors: DataFrame, *, every: int, top: int) -> DataFrame:
    """For each row of ``vectors`` (vec_id, embedding) whose vec_id is divisible by
    ``every`` its ``top`` nearest other rows: query_id, rank (from 1), vec_id, score.

    Score is the inner product in double precision; ties go to the smaller vec_id.
    Rows take no part whose vec_id or vector is null, whose vector is zero or has a
    null or non-finite component, or is not as long as most vectors. Equal vectors
    with different vec_ids are different rows. An empty table gives no rows."""
    rows = written(_usable(vectors), "vectors")
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("n"), F.max(
        F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    ).alias("square"))
    most = sizes.orderBy(F.desc("n"), "size").first()
    kinds = "query_id long, vec_id long, score double"
    if most is None:
        found = rows.sparkSession.createDataFrame([], kinds)
    else:
        rows = rows.where(F.size("vector") == most["size"])
        sample = rows.orderBy(F.xxhash64("vec_id")).limit(FIT_ROWS).select("vector").collect()
        model = learn(np.array([r["vector"] for r in sample]), float(np.sqrt(most["square"])), top)
        asking = F.col("vec_id") % every == 0
        row_blocks = -(-most["n"] // ROW_BLOCK)
        query_blocks = max(1, -(-rows.where(asking).count() // QUERY_BLOCK))
        block = F.pmod(F.xxhash64("vec_id"), F.lit(row_blocks)).cast("int")
        query_block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(query_blocks)).cast("int")
        each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(int(n) - 1)))
        data = rows.select("vec_id", "vector", F.lit(False).alias("asks"), block.alias("b"), each(query_blocks).alias("q"))
        queries = rows.where(asking).select(
            "vec_id", "vector", F.lit(True).alias("asks"), query_block.alias("q"), each(row_blocks).alias("b")
        )
        met = data.unionByName(queries).groupBy("b", "q").applyInArrow(_nearest(model, top), kinds)
        found = met
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
