"""Quality rules with thresholds that adapt to language and source.

Base counts are taken of every whole text with built-in functions. Then, for each
(lang, source), mergeable quantile sketches of the counts' rates over all documents
that pass the base rules give fences, which are joined to the documents.

A group's lower half cannot be moved by less than half of junk, so a fence may always
lie SPREADS times the lower spread above the median. Its upper tail may be junk: what
that would allow is allowed only as far as the median group of the language and the
median group of all allow it too, each group having one vote whatever its size. Groups
too small to vote are judged by those medians. No fence lies below one occurrence in a
document of median length, and a document's count may exceed what its fence expects by
NOISE times the spread that a count of that size has by chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.llm.scratch import written

_SPACE = "[\\x20\\x09-\\x0D]+"
# Rank error of the sketches is 1/ACCURACY of a group; smaller groups are exact.
ACCURACY = 10_000
# Documents that a group needs for fences and a vote of its own.
LEAST_DOCUMENTS = 30
SPREADS = 5.0
NOISE = 2.0


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def measured(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines (those with a word),
    n_dup_lines and n_repeat_words. Null text counts as having none of them."""
    text = F.coalesce("text", F.lit(""))
    # One row at a time: each step is a column of its own, so nothing is computed twice.
    rows = docs.withColumn("_text", text).withColumn("_words", _words(F.col("_text")))
    rows = rows.withColumn("n_words", F.size("_words").cast("long"))
    rows = rows.withColumn(
        "word_chars", F.length(F.regexp_replace("_text", _SPACE, "")).cast("long")
    ).withColumn("n_symbols", (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("long"))
    rows = rows.withColumn(
        "_lines", F.filter(F.split("_text", "\n"), lambda x: F.length(F.regexp_replace(x, _SPACE, "")) > 0)
    )
    rows = rows.withColumn("n_lines", F.size("_lines").cast("long"))
    rows = rows.withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
    return rows.withColumn("n_repeat_words", _repeat_words().cast("long")).drop("_text", "_words", "_lines")


def _repeat_words() -> Column:
    """Words in 3-word windows found twice or more in the text.

    The windows' hashes are sorted with their places packed into the low bits, which
    leaves the few windows with a like neighbour; of those the whole hashes are
    compared. A window adds three words, less those it shares with the one before."""
    return F.expr(
        """
        CASE WHEN size(_words) < 4 THEN 0 ELSE
        aggregate(
          array(transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2]))),
          0,
          (none, windows) -> aggregate(
            array(shiftleft(1L, length(bin(size(windows)))) - 1),
            0,
            (none2, low) -> aggregate(
              array(sort_array(transform(windows, (h, i) -> (h & ~low) | i))),
              0,
              (none3, packed) -> aggregate(
                array(array_sort(transform(
                  filter(packed, (x, j) ->
                    (j > 0 AND (get(packed, j - 1) & ~low) = (x & ~low))
                    OR (j + 1 < size(packed) AND (get(packed, j + 1) & ~low) = (x & ~low))),
                  x -> struct(windows[int(x & low)] AS h, int(x & low) AS i)))),
                0,
                (none4, near) -> aggregate(
                  array_sort(transform(
                    filter(near, (x, j) ->
                      (j > 0 AND get(near, j - 1).h = x.h) OR (j + 1 < size(near) AND get(near, j + 1).h = x.h)),
                    x -> x.i)),
                  struct(-3 AS last, 0 AS total),
                  (s, i) -> struct(i AS last, s.total + least(3, i - s.last) AS total),
                  s -> s.total)))))
        END
        """
    )


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


# Each measure is a count and the length it is a rate of.
MEASURES = {
    "symbols": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "letters": ("word_chars", "n_words"),
}


def _fences(good: DataFrame, *keys: str) -> DataFrame:
    """By group: documents, and for each measure the fence that its lower half allows
    (low_) and that its upper tail would allow (high_)."""
    sketches = []
    for n, (count, length) in MEASURES.items():
        sketches.append(F.percentile_approx(F.col(count) / F.col(length), [0.1, 0.5, 0.9], ACCURACY).alias(n))
        sketches.append(F.percentile_approx(length, 0.5, ACCURACY).alias(f"{n}_length"))
    columns = []
    for n in MEASURES:
        q, one = F.col(n), F.lit(1.0) / F.col(f"{n}_length")
        columns.append(F.greatest(q[1] + SPREADS * (q[1] - q[0]), one).alias(f"low_{n}"))
        columns.append(F.greatest(q[2] + SPREADS * (q[2] - q[1]), one).alias(f"high_{n}"))
    return good.groupBy(*keys).agg(F.count("*").alias("documents"), *sketches).select(*keys, "documents", *columns)


def _verdicts(docs: DataFrame, name: list[str]) -> DataFrame:
    """The counts, base_failed and kept, with the columns ``name`` of ``docs``."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    groups = [c for c in ("lang", "source") if c not in name]
    rows = written(
        measured(docs.select(*name, *groups, "text"))
        .select(*name, *groups, *COUNTS, "n_lines")
        .withColumn("base_failed", failed),
        "quality-counts",
    )
    good = rows.where(~F.col("base_failed"))
    voters = written(_fences(good, "lang", "source").where(F.col("documents") >= LEAST_DOCUMENTS), "quality-fences")
    medians = [F.percentile_approx(f"high_{n}", 0.5, ACCURACY).alias(n) for n in MEASURES]
    # One row. Where no group has a vote, all documents are one group.
    of_all = voters.agg(*medians).first()
    if of_all["letters"] is None:
        of_all = _fences(good).agg(*medians).first()

    own = voters.withColumnsRenamed({"lang": "l1", "source": "s1"}).drop("documents")
    language = voters.groupBy(F.col("lang").alias("l2")).agg(*medians)
    found = rows.join(own, F.col("lang").eqNullSafe(F.col("l1")) & F.col("source").eqNullSafe(F.col("s1")), "left").join(
        language, F.col("lang").eqNullSafe(F.col("l2")), "left"
    )
    inside = F.lit(True)
    for n, (count, length) in MEASURES.items():
        # Groups without own fences and languages without voters are passed over.
        allowed = F.least(f"high_{n}", n, F.lit(of_all[n]).cast("double"))
        expected = F.greatest(f"low_{n}", allowed) * F.col(length)
        inside = inside & (F.col(count) <= expected + NOISE * F.sqrt(expected + 1.0))
    return found.select(
        *name, *COUNTS, "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept")
    )


def judged(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, base_failed and kept.

    base_failed: fewer than 50 words, or more than half of them in repeated windows.
    kept: passes the base rules and no count is beyond its fence. A null lang or source
    is a group like others. Repeated rows are judged alike."""
    return _verdicts(docs, ["doc_id"])


def kept(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, as they are. Rows alike in doc_id, lang,
    source and text share one verdict."""
    key = F.xxhash64("doc_id", "lang", "source", "text")
    keyed = docs.select(F.struct("*").alias("row"), key.alias("row_key"))
    named = keyed.select("row_key", "row.lang", "row.source", "row.text")
    good = _verdicts(named, ["row_key"]).where("kept").select("row_key").distinct()
    return keyed.join(good, "row_key", "left_semi").select("row.*")
