"""Column expressions shared by the plans. All are JVM built-ins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.schemas import MONEY


def normalise_text(column: str) -> Column:
    return F.lower(F.trim(F.col(column)))


def hash_email(column: str, salt: str) -> Column:
    """Salted SHA-256 in hex. ``concat_ws`` skips nulls, so a null address is
    kept null instead of sharing the digest of the salt alone."""
    email = F.col(column)
    return F.when(email.isNotNull(), F.sha2(F.concat_ws(":", email, F.lit(salt)), 256))


def mask_phone(column: str) -> Column:
    return F.concat(F.lit("***-***-"), F.substring(F.col(column), -4, 4))


def money(column: Column) -> Column:
    return column.cast(MONEY)


def surrogate_key(column: str) -> Column:
    """128-bit key, the MD5 of a business key in hex: the same value in every
    engine, and without collisions at any number of keys a business can have."""
    return F.md5(F.col(column))


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def ratio(amount: Column, count: Column) -> Column:
    """Amount per unit to two places; null when there is nothing to divide by."""
    return F.round(F.try_divide(amount, count), 2)


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part.cast("decimal(20,2)") * 100, whole), 2)


def utc_timestamps(df: DataFrame) -> DataFrame:
    """Turn every ``*_at`` / ``*_timestamp`` column into a timestamp. Text must
    be ISO-8601 and may carry an offset."""
    times = {
        field.name: F.col(field.name).cast(T.TimestampType())
        for field in df.schema.fields
        if field.name.endswith(("_at", "_timestamp"))
        and field.dataType != T.TimestampType()
    }
    return df.withColumns(times) if times else df
