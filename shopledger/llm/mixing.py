"""Mixing of documents to target weights by soft domain membership.

A classifier learned from a labelled table gives every document posteriors of its
domain. Then nonnegative rates of the documents are fitted so that the expected
token totals of the domains meet their targets: least squares by projected gradient
steps, accelerated, from a rate of one. A step changes a document's rate by its
posteriors times the totals' relative errors, so the steps are kept as a short list
of errors, and the rate of any document follows from the list and its posteriors.
Each step is one distributed sum over the corpus, grouped beforehand by rounded
posteriors, of which there is a fixed number of combinations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.batches import chunks, texts_of
from shopledger.llm.hashing import word_hashes
from shopledger.llm.scratch import written

# Words are counted in so many cells of their hash.
CELLS = 1 << 16
# Posteriors are rounded to multiples of 1 / GRID.
GRID = 1024
# Labelled rows, chosen by a hash of their text, that set cutoff and sharpness, each
# judged by the word counts of the half of the labelled rows it is not in.
SHARPNESS_ROWS = 5_000
# A word counts if it is in so many labelled documents, and their number in a domain is
# off from its share of all by more than one of the cutoffs, in standard deviations.
LEAST_DOCUMENTS = 5
CUTOFFS = (2.0, 3.0, 4.0, 6.0, 8.0, 10.0, 12.0)
# Marks, chosen by a hash of their doc_id, that the classifier is fitted on. They are
# broadcast (under 1 MB), so that no text is shuffled to meet its mark.
LABELLED_ROWS = 50_000
# Documents by which a word's rate in a domain is drawn to its rate in all.
SMOOTHING = 10.0
# The steps end when no domain's projected gradient is off by more than this share of all
# tokens; a fit that does not get there raises.
CLOSE_ENOUGH = 1e-7
MOST_STEPS = 100
# Weight of keeping rates at one against meeting the targets.
KEEP = 1e-8


class MixingError(RuntimeError):
    """The rates did not converge."""


@dataclass(frozen=True)
class Classifier:
    """Log of a word cell's rate of documents in each domain against its rate in all,
    log priors, and the sharpness by which a document's evidence, the sum over its
    distinct cells, is scaled."""

    domains: tuple[str, ...]
    weights: np.ndarray
    priors: np.ndarray
    sharpness: float

    def posteriors(self, evidence: np.ndarray) -> np.ndarray:
        scores = self.priors + self.sharpness * evidence
        scores = np.exp(scores - scores.max(1, keepdims=True))
        return scores / scores.sum(1, keepdims=True)


def _cells(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct cells of each text, where each text's begin, and its number of words."""
    hashes, firsts = word_hashes(texts)
    words = np.diff(firsts)
    text = np.repeat(np.arange(len(texts)), words)
    found = np.unique(text * CELLS + (hashes >> np.uint64(48)).astype(np.int64))
    return found % CELLS, np.searchsorted(found, np.arange(len(texts) + 1) * CELLS), words


def _evidence(texts: list[bytes], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the weights over the distinct cells of each text, and its number of words."""
    cells, firsts, words = _cells(texts)
    sums = np.zeros((len(cells) + 1, weights.shape[1]))
    np.cumsum(weights[cells], axis=0, out=sums[1:])
    return sums[firsts[1:]] - sums[firsts[:-1]], words


def _document_counts(domains: int):
    """Documents of each half and domain that hold a cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = 2 * domains
        counts = np.zeros(CELLS * kinds, dtype=np.int64)
        for batch in batches:
            texts = texts_of(batch.column("text"))
            kind = batch.column("half").to_numpy() * domains + batch.column("domain").to_numpy()
            for a, b in chunks(texts):
                cells, firsts, _ = _cells(texts[a:b])
                counts += np.bincount(cells * kinds + np.repeat(kind[a:b], np.diff(firsts)), minlength=CELLS * kinds)
        at = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], ["at", "n"])

    return run


def _weights(counts: np.ndarray, rows: np.ndarray, cutoff: float) -> np.ndarray:
    """Weights of the cells from their documents per domain and all documents per domain."""
    documents = counts.sum(1, keepdims=True)
    rate = documents / max(rows.sum(), 1)
    expected = rate * rows
    telling = (np.abs(counts - expected) > cutoff * np.sqrt(expected)).any(1, keepdims=True)
    drawn = (counts + SMOOTHING * rate) / (rows + SMOOTHING)
    logs = np.log(np.where(documents > 0, drawn, 1) / np.where(documents > 0, rate, 1))
    return np.where(telling & (documents >= LEAST_DOCUMENTS), logs - logs.mean(1, keepdims=True), 0)


def learn(labelled: DataFrame, domains: tuple[str, ...]) -> Classifier:
    """A classifier from rows with ``text`` and ``domain``, the number of a domain.
    Word counts are summed over all rows; cutoff and sharpness are those with the best
    likelihood on a bounded sample, of which each row is judged by the counts of the
    other half of the rows (copies of a text are in the same half). Without rows all
    posteriors are alike."""
    k = len(domains)
    labelled = labelled.withColumn("half", F.xxhash64("text").bitwiseAND(1).cast("int"))
    # At most 2 * CELLS * k rows.
    found = (
        labelled.mapInArrow(_document_counts(k), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(CELLS * 2 * k)
    counts[found.column("at").to_numpy()] = found.column("n").to_numpy()
    counts = counts.reshape(CELLS, 2, k)
    rows = np.zeros((2, k))
    for r in labelled.groupBy("half", "domain").count().collect():
        rows[r["half"], r["domain"]] = r["count"]
    priors = np.log((rows.sum(0) + 1) / (rows.sum(0) + 1).sum())
    # For the rows of a half: the weights of the other, all cutoffs side by side.
    others = [np.hstack([_weights(counts[:, 1 - h], rows[1 - h], c) for c in CUTOFFS]).astype(np.float32) for h in (0, 1)]

    def evidence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, half = texts_of(batch.column("text")), batch.column("half").to_numpy()
            sums = np.zeros((len(texts), others[0].shape[1]))
            for a, b in chunks(texts):
                for h in (0, 1):
                    mine = a + np.flatnonzero(half[a:b] == h)
                    if len(mine):
                        sums[mine] = _evidence([texts[i] for i in mine], others[h])[0]
            yield pa.RecordBatch.from_arrays(
                [batch.column("domain"), pa.array(sums.tolist(), type=pa.list_(pa.float64()))], ["domain", "evidence"]
            )

    sample = (
        labelled.select("text", "domain", "half", F.xxhash64("text").alias("h"))
        .orderBy("h")
        .limit(SHARPNESS_ROWS)
        .drop("h")
        .mapInArrow(evidence, "domain int, evidence array<double>")
        .collect()
    )
    best, cutoff, sharpness = -np.inf, CUTOFFS[0], 0.0
    if sample:
        held = np.array([r["evidence"] for r in sample]).reshape(len(sample), len(CUTOFFS), k)
        truth = np.array([r["domain"] for r in sample])
        for i, c in enumerate(CUTOFFS):
            for s in (0.0, *np.geomspace(0.02, 8, 24)):
                p = Classifier(domains, others[0], priors, s).posteriors(held[:, i])
                fit = np.log(np.maximum(p[np.arange(len(truth)), truth], 1e-12)).mean()
                if fit > best:
                    best, cutoff, sharpness = fit, c, float(s)
    return Classifier(domains, _weights(counts.sum(1), rows.sum(0), cutoff), priors, sharpness)


def classified(docs: DataFrame, model: Classifier) -> DataFrame:
    """doc_id, tokens (words of the text), grid, the posteriors as an array of integers
    that sum to about GRID, and the row's key. Null text has no words: the priors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("text"))
            tokens, grids = [], []
            for a, b in chunks(texts):
                found, words = _evidence(texts[a:b], model.weights)
                tokens.append(words)
                grids.append(np.rint(model.posteriors(found) * GRID).astype(np.int64))
            if not texts:
                continue
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.concatenate(tokens)),
                    pa.array(np.concatenate(grids).tolist(), type=pa.list_(pa.int64())),
                    batch.column("key"),
                ],
                ["doc_id", "tokens", "grid", "key"],
            )

    return docs.select("doc_id", "text", row_key().alias("key")).mapInArrow(
        run, "doc_id long, tokens long, grid array<long>, key binary"
    )


def _share(k: int) -> Column:
    return F.col("grid")[k] / F.expr("aggregate(grid, 0L, (a, x) -> a + x)")


def _rate(pull: tuple[float, ...]) -> Column:
    """Rate of a document with posteriors ``p``: one, moved by each domain's pull in
    proportion to the domain's posterior, and projected onto what is not negative."""
    moved = " + ".join(f"{x!r}D * p[{i}]" for i, x in enumerate(pull))
    return F.expr(f"greatest(0D, 1D + {moved})")


@dataclass(frozen=True)
class Mixture:
    """The fitted pull of each domain; ``shares`` are the domains' token shares before
    and ``reached`` those of the total after mixing. ``reached`` differs from ``wanted``
    where no nonnegative rates meet the targets."""

    pull: tuple[float, ...]
    shares: tuple[float, ...]
    wanted: tuple[float, ...]
    reached: tuple[float, ...]


def fit(rows: DataFrame, targets: list[float] | None, aim=None) -> Mixture:
    """Rates for classified rows. ``targets`` are the domains' wanted token totals as
    shares of all tokens; or ``aim`` gives them from the present shares.

    The rates minimise the squares of the totals' errors and, with the tiny weight
    ``KEEP``, of what they differ from one. Along the gradient a document's rate moves
    by its posteriors times one number per domain, so these numbers are all the state:
    each step sums, in one pass over the grouped posteriors, the errors at the projected
    rates and the Gram matrix of the rows with a positive rate, by which the gradient is
    scaled; a step that does not lower the objective is halved. Plans are of one size."""
    k = len(targets) if targets is not None else len(rows.select("grid").first()["grid"])
    # At most (GRID + 2)**domains rows, in fact those near the simplex.
    groups = written(rows.groupBy("grid").agg(F.sum("tokens").cast("double").alias("tokens")), "mixing-groups")
    groups = groups.select("tokens", F.array(*(_share(i) for i in range(k))).alias("p"))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]

    def sums(pull: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray, float]:
        """Totals, Gram matrix, and half the sum of squared rates, by tokens."""
        met = groups.select("tokens", "p", _rate(pull).alias("r"))
        weight, p, r = F.col("tokens"), F.col("p"), F.col("r")
        wanted = [weight * r * p[i] for i in range(k)]
        wanted += [F.when(r > 0, weight * p[i] * p[j]).otherwise(0.0) for i, j in pairs]
        wanted.append(weight * r * r / 2)
        found = np.array(met.agg(*(F.coalesce(F.sum(x), F.lit(0.0)) for x in wanted)).first(), dtype=float)
        gram = np.zeros((k, k))
        for (i, j), x in zip(pairs, found[k:-1], strict=True):
            gram[i, j] = gram[j, i] = x
        return found[:k], gram, float(found[-1])

    pull = np.zeros(k)
    present, gram, half = sums(tuple(pull.tolist()))
    total = max(present.sum(), 1.0)
    shares = present / total
    wanted = np.array(targets if targets is not None else aim(shares.tolist()), dtype=float)

    def objective(at: np.ndarray, half: float) -> float:
        return half / total - wanted @ at + KEEP * (at @ at) / 2

    reached, value = shares, objective(pull, half)
    for _ in range(MOST_STEPS):
        gradient = reached - wanted + KEEP * pull
        # Without tokens there is nothing to move.
        if not present.any() or np.abs(gradient).max() <= CLOSE_ENOUGH:
            return Mixture(tuple(pull.tolist()), tuple(shares), tuple(wanted), tuple(reached))
        step = -np.linalg.solve(gram / total + KEEP * np.eye(k), gradient)
        size = 1.0
        while True:
            tried = pull + size * step
            totals, gram_there, half = sums(tuple(tried.tolist()))
            there = objective(tried, half)
            if there <= value + 1e-4 * size * (gradient @ step) or size < 1e-9:
                break
            size /= 2
        pull, reached, gram, value = tried, totals / total, gram_there, there
    raise MixingError(f"After {MOST_STEPS} steps the shares are {reached.tolist()}, wanted {wanted.tolist()}")


def with_rates(rows: DataFrame, mixture: Mixture, domains: tuple[str, ...]) -> DataFrame:
    """doc_id, tokens, a posterior column per domain, rate, copies, and key, which tells
    rows of one doc_id apart by their text. Copies is the rate rounded up or down by a
    hash of the key, so that it is the rate on average."""
    rows = rows.withColumn("p", F.array(*(_share(i) for i in range(len(domains)))))
    rows = rows.withColumn("rate", _rate(mixture.pull))
    chance = F.shiftrightunsigned(F.xxhash64("key", F.lit("copies")), 11) / F.lit(float(1 << 53))
    return rows.select(
        "doc_id",
        "tokens",
        *(F.col("p")[i].alias(f"p_{d}") for i, d in enumerate(domains)),
        "rate",
        F.floor(F.col("rate") + chance).cast("int").alias("copies"),
        "key",
    )


def row_key() -> Column:
    """What tells rows apart that differ in doc_id or text: 128 bits of both."""
    doc_id, text = F.col("doc_id").cast("string"), F.col("text")
    framed = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in (doc_id, text)]
    return F.unhex(F.md5(F.concat(*framed)))


# Domains of the labels table: what its two marks say together.
DOMAINS = ("high", "low", "toxic")


def labelled_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and domain of the documents that ``labels`` (doc_id, quality, toxic) covers.
    Labels with a null mark are not used; of a doc_id labelled twice, one is; of more than
    ``LABELLED_ROWS``, so many."""
    domain = F.when(F.col("toxic") == 1, 2).when(F.col("quality") == 1, 0).otherwise(1)
    marks = labels.where("quality is not null and toxic is not null").select("doc_id", domain.cast("int").alias("domain"))
    marks = marks.groupBy("doc_id").agg(F.max("domain").alias("domain"))
    marks = marks.where("doc_id is not null").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED_ROWS)
    return docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "domain")


def mixed(docs: DataFrame, labels: DataFrame, *, targets: list[float] | None = None, aim=None) -> DataFrame:
    """Every row of ``docs`` with its rate in the mixture: doc_id, tokens, p_high, p_low,
    p_toxic, rate, copies, key. Repeated rows have equal rates and keys. Without labels all
    posteriors are alike, and the rates meet the targets as far as they can."""
    model = learn(written(labelled_documents(docs, labels), "mixing-labelled"), DOMAINS)
    rows = written(classified(docs, model), "mixing-rows")
    return with_rates(rows, fit(rows, targets, aim), DOMAINS)
