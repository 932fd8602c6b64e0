"""Paging over an ordered feed, by offset or by the last key seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MAX_PAGE_ROWS = 500


def ordered_page(df: DataFrame, order: Sequence[str], *, offset: int = 0, limit: int = 100) -> DataFrame:
    """Rows ``offset .. offset+limit`` in the given order, with the feed's total
    and whether more rows follow.

    Runs as a top-k: each task keeps its first ``offset + limit`` rows. A reader
    that wants the whole feed uses ``changed_since`` instead of paging.
    """
    if offset < 0:
        raise ValueError("offset must not be negative")
    if not 1 <= limit <= MAX_PAGE_ROWS:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE_ROWS}")
    total = df.agg(F.count(F.lit(1))).scalar()
    page = df.orderBy(*order).offset(offset).limit(limit)
    return page.withColumn("total", total).withColumn("has_more", F.col("total") > offset + limit)


def _beyond(column: str, value: object) -> Column:
    # Nulls come first.
    return F.col(column).isNotNull() if value is None else F.col(column) > F.lit(value)


def seek_page(
    df: DataFrame, order: Sequence[str], *, after: Sequence[object] | None = None, limit: int = 100
) -> DataFrame:
    """The first ``limit`` rows whose ``order`` values come after those of the last row
    seen, and whether more rows follow. ``order`` tells all rows apart.

    The leading column has a bound of its own, which files sorted by it skip row groups
    by. Each task keeps ``limit`` + 1 rows, however far into the feed the page lies."""
    if not 1 <= limit <= MAX_PAGE_ROWS:
        raise ValueError(f"limit must be between 1 and {MAX_PAGE_ROWS}")
    if after is not None:
        if len(after) != len(order):
            raise ValueError("after needs a value for each column of the order")
        later, equal = F.lit(False), F.lit(True)
        for column, value in zip(order, after):
            later = later | (equal & _beyond(column, value))
            equal = equal & F.col(column).eqNullSafe(F.lit(value))
        if after[0] is not None:
            df = df.where(F.col(order[0]) >= F.lit(after[0]))
        df = df.where(later)
    found = df.orderBy(*order).limit(limit + 1)
    # At most limit + 1 rows.
    rank = F.row_number().over(Window.orderBy(*order))
    return (
        found.withColumns({"_rank": rank, "has_more": F.count(F.lit(1)).over(Window.partitionBy()) > limit})
        .where(F.col("_rank") <= limit)
        .drop("_rank")
    )
