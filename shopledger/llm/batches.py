"""Arrow helpers for functions that see one part of a table at a time."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Texts handled at once by the numpy code, in bytes. Its working memory is some
# ten times this; one longer text is handled alone.
CHUNK_BYTES = 2_000_000


def texts_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [t or b"" for t in column.cast(pa.large_binary()).to_pylist()]


def chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of about ``limit`` bytes together."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Send at most ``rows`` rows at once to Python while the block runs, as a batch lies
    in memory on both sides. The setting is the session's: run one block at a time."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(name))
    spark.conf.set(name, str(min(before, rows) if before > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


def slices(batch: pa.RecordBatch, column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batch`` with about ``limit`` bytes of the string or binary
    ``column`` together; a longer value comes alone."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    turns = np.flatnonzero(np.diff(np.cumsum(sizes, dtype=np.int64) // limit)) + 1
    for a, b in zip([0, *turns], [*turns, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def longs(values: np.ndarray) -> pa.Array:
    """Signed 64-bit column with the bits of ``values``."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))
