"""Exact token counts of every prefix of a text, by dynamic programming.

count(prefix) = count(prefix up to the last word's start) + tokens of that word,
so one pass over the words stores the count at every word end; a prefix that ends
inside a word needs only the few characters since the last end that a longer
prefix could cut differently. Truncation and budget questions are then look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shopledger.llm.vocabularies import BYTE_PIECES, Words, kept

_SPACES = " \t\n\r"


@dataclass(frozen=True)
class PrefixCounts:
    """``counts[i]`` tokens in the first ``ends[i]`` characters, by rising end."""

    text: str
    ends: np.ndarray
    counts: np.ndarray
    words: Words

    @property
    def total(self) -> int:
        return int(self.counts[-1])

    def of_prefix(self, chars: int) -> int:
        """Tokens of the first ``chars`` characters, as if they were the text."""
        chars = max(0, min(chars, len(self.text)))
        if chars == len(self.text):
            return self.total
        # White space is cut by what follows it, and an ending such as 'll only
        # when it is whole, so counting starts at a word end before both.
        at = chars
        while at and self.text[at - 1] in _SPACES:
            at -= 1
        i = max(0, int(np.searchsorted(self.ends, at, side="right")) - 1)
        while i and (self.ends[i] >= chars or self.text[self.ends[i] - 1] in _SPACES):
            i -= 1
        start = int(self.ends[i])
        tail = self.text[start:chars]
        return int(self.counts[i]) + sum(self.words[w] for w in self.words.split(tail))

    def longest_within(self, budget: int) -> int:
        """Most characters c such that no prefix up to the word end before c has
        more than ``budget`` tokens and the first c characters have at most that."""
        i = int(np.searchsorted(self.counts, budget, side="right")) - 1
        if i < 0:
            return 0
        if i == len(self.ends) - 1:
            return len(self.text)
        for c in range(int(self.ends[i + 1]), int(self.ends[i]), -1):
            if self.of_prefix(c) <= budget:
                return c
        return int(self.ends[i])


@dataclass(frozen=True)
class LibraryCounts:
    """The same questions for a text that only the library can cut: each prefix is
    encoded."""

    text: str
    words: Words

    @property
    def total(self) -> int:
        return len(self.words.ids(self.text))

    def of_prefix(self, chars: int) -> int:
        return len(self.words.ids(self.text[: max(0, chars)]))

    def longest_within(self, budget: int) -> int:
        spans = self.words.library.encode(self.text, add_special_tokens=False).offsets
        if len(spans) <= budget:
            return len(self.text)
        c = spans[budget][0]
        while c and self.of_prefix(c) > budget:
            c -= 1
        return c


def byte_words(path: str) -> Words:
    """Token counts by word for a byte-level vocabulary in a tokenizers file."""
    return kept(f"counts:{path}", lambda: Words(path, BYTE_PIECES, lower=False, value=len))


def prefix_counts(text: str | None, words: Words) -> PrefixCounts | LibraryCounts:
    """Prefix counts of a text; null counts as empty."""
    text = text or ""
    if not words.certain(text):
        return LibraryCounts(text, words)
    pieces = words.split(text)
    ends = np.zeros(len(pieces) + 1, dtype=np.int64)
    counts = np.zeros(len(pieces) + 1, dtype=np.int64)
    np.cumsum(np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)), out=ends[1:])
    np.cumsum(np.fromiter(map(words.__getitem__, pieces), dtype=np.int64, count=len(pieces)), out=counts[1:])
    return PrefixCounts(text, ends, counts, words)


def token_counts(docs: DataFrame, *, vocabulary: str, limit: int) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes of the text in UTF-8, n_tokens
    of the whole text and over_limit, whether those are more than ``limit``.

    ``vocabulary`` is the path of a tokenizers file on every machine. Null text
    counts as empty: 0 bytes, 0 tokens. A null doc_id stays null, repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = byte_words(vocabulary)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            tokens = [prefix_counts(t, words).total for t in texts]
            sizes = [len((t or "").encode()) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, type=pa.int64()),
                    pa.array(tokens, type=pa.int64()),
                    pa.array([n > limit for n in tokens], type=pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    )


def prefix_tables(docs: DataFrame, *, vocabulary: str) -> DataFrame:
    """The stored counts: per row of ``docs`` doc_id, ``ends`` (characters) and
    ``counts`` (tokens in as many characters). A text for the library alone has its
    two ends only. Questions at other places go to ``prefix_counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = byte_words(vocabulary)
        for batch in batches:
            ends, counts = [], []
            for text in batch.column("text").to_pylist():
                c = prefix_counts(text, words)
                whole = isinstance(c, LibraryCounts)
                ends.append([0, len(c.text)] if whole else c.ends.tolist())
                counts.append([0, c.total] if whole else c.counts.tolist())
            kinds = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(ends, type=kinds), pa.array(counts, type=kinds)],
                ["doc_id", "ends", "counts"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ends array<long>, counts array<long>")


def truncated(docs: DataFrame, *, vocabulary: str, budget: int) -> DataFrame:
    """``docs`` with each text cut to its longest prefix within ``budget`` tokens
    (see ``longest_within``). Null stays null; other columns stay."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = byte_words(vocabulary)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            cut = [
                None if t is None else t[: prefix_counts(t, words).longest_within(budget)]
                for t in batch.column(at).to_pylist()
            ]
            columns = [pa.array(cut, type=pa.string()) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, kinds)
