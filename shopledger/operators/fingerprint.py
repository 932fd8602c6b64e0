"""A checksum of a table's rows that does not depend on their order."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Wide enough that the sum of any number of 64-bit hashes is exact.
_WIDE = "decimal(28,0)"
_SUM = "decimal(38,0)"


def _row_hash(columns: list[str], salt: int) -> Column:
    # A null leaves the hash as it is, so whether a value is there is hashed as well.
    values = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(salt), *values).cast(_WIDE)


def checksums(columns: Iterable[str]) -> list[Column]:
    """The aggregates of a fingerprint, also to be observed while a table is written."""
    columns = sorted(columns)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(_row_hash(columns, 1)), F.lit(0)).alias("first_sum"),
        F.coalesce(F.sum(_row_hash(columns, 2)), F.lit(0)).alias("second_sum"),
    ]


def fingerprint(df: DataFrame) -> DataFrame:
    """One row (rows, first_sum, second_sum): the number of rows and the exact sums of
    two hashes of whole rows. Tables with the same rows, each as often, agree in all
    three; a changed value, or a row doubled beside a lost one, changes both sums. Columns
    count by name, not by order. One pass, nothing is shuffled but the sums."""
    return df.agg(*checksums(df.columns))


def same_rows(first: DataFrame | Mapping[str, Any], second: DataFrame) -> DataFrame:
    """One row (first_rows, second_rows, same): whether two tables hold the same rows. The
    first may be the fingerprint that was observed while it was written."""
    other = fingerprint(second).select(F.struct("*").alias("other"))
    if isinstance(first, DataFrame):
        found = fingerprint(first).select(F.struct("*").alias("one")).withColumn("other", other.scalar())
    else:
        kinds = {"rows": "bigint", "first_sum": _SUM, "second_sum": _SUM}
        one = F.struct(*(F.lit(str(first[name])).cast(kind).alias(name) for name, kind in kinds.items()))
        found = other.select(one.alias("one"), "other")
    return found.select(
        F.col("one.rows").alias("first_rows"),
        F.col("other.rows").alias("second_rows"),
        (F.col("one") == F.col("other")).alias("same"),
    )
