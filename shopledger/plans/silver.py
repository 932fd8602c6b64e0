"""Bronze to Silver: project, cast, protect, then keep the latest row per key.

Projection comes before deduplication, so raw personal columns never enter a
shuffle and the tie-breakers are Silver columns.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions import hash_email, mask_phone, money, normalise_text
from shopledger.operators import latest_by_key
from shopledger.schemas import PRIMARY_KEYS, SILVER_SCHEMAS, SOURCES

Silver = Mapping[str, DataFrame]


# Text columns whose spelling the sources do not agree on.
_NORMALISED = ("order_status", "payment_method", "channel", "event_type")
_COMPUTED = "line_amount"


def _silver_column(field: T.StructField, salt: str) -> Column:
    """A Silver column: the source column of its name, unless it has a rule."""
    if field.name == "email_hash":
        value = hash_email("email", salt)
    elif field.name == "phone_masked":
        value = mask_phone("phone")
    elif field.name == "customer_city":
        value = F.col("city")
    elif field.name in _NORMALISED:
        value = normalise_text(field.name)
    else:
        value = F.col(field.name)
    return value.cast(field.dataType).alias(field.name)


def with_line_amount(items: DataFrame) -> DataFrame:
    return items.withColumn(_COMPUTED, money(F.col("quantity") * F.col("unit_price")))


def shaped(name: str, bronze: DataFrame, *, salt: str) -> DataFrame:
    """Bronze rows as rows of Silver table ``name``, of which the latest counts."""
    fields = [field for field in SILVER_SCHEMAS[name].fields if field.name != _COMPUTED]
    return bronze.select(*(_silver_column(field, salt) for field in fields))


def silver_table(name: str, bronze: DataFrame, *, salt: str) -> DataFrame:
    """Silver table ``name`` from all its Bronze rows."""
    current = latest_by_key(shaped(name, bronze, salt=salt), [PRIMARY_KEYS[name]], ["updated_at"])
    return with_line_amount(current) if name == "order_items" else current


def _row(name: str) -> Column:
    """A Silver row as a struct that is the greater, the later the row is."""
    key = PRIMARY_KEYS[name]
    others = [c for c in SILVER_SCHEMAS[name].fieldNames() if c not in (key, "updated_at")]
    return F.struct("updated_at", *others, key)


def changes_schema(name: str) -> T.StructType:
    key, schema = PRIMARY_KEYS[name], SILVER_SCHEMAS[name]
    others = [c for c in schema.fieldNames() if c not in (key, "updated_at")]
    row = T.StructType([schema[c] for c in ("updated_at", *others, key)])
    return T.StructType([T.StructField("was", row), T.StructField("now", row)])


def changes(name: str, current: DataFrame, incoming: DataFrame) -> DataFrame:
    """What ``incoming`` rows, one per key, change in the ``current`` ones: rows (was, now) of
    the keys whose latest row is another; ``was`` is null for a new key. An incoming row
    that is older than the current one changes nothing, whenever it arrives.

    The current table is only looked up by the incoming keys: with a small batch these
    are broadcast, and the table is neither shuffled nor sorted. They meet by plain
    equality, so incoming rows that an aggregate has dealt out by the key stay where they
    are; the one row that may have no key is looked up by itself."""
    key = PRIMARY_KEYS[name]
    new = incoming.select(F.col(key).alias("_key"), _row(name).alias("_new"))
    old, old_key = current.select(_row(name).alias("was")), F.col(f"was.{key}")
    unkeyed = old.where(old_key.isNull()).agg(F.max("was"))
    old = old.join(new.select("_key"), old_key == F.col("_key"), "left_semi")
    now = F.greatest("was", "_new")
    met = new.join(old, F.col("_key") == old_key, "left").withColumn(
        "was", F.when(F.col("_key").isNull(), unkeyed.scalar()).otherwise(F.col("was"))
    )
    return met.where(~F.col("was").eqNullSafe(now)).select("was", now.alias("now"))


def with_changes(name: str, current: DataFrame, changed: DataFrame) -> DataFrame:
    """The ``current`` rows after their changes."""
    key = PRIMARY_KEYS[name]
    now = changed.select("now.*").select(*current.columns)
    keys = now.select(F.col(key).alias("_key"))
    return current.join(keys, F.col(key).eqNullSafe(F.col("_key")), "left_anti").unionByName(now)


def build_silver(bronze: Mapping[str, DataFrame], *, salt: str) -> dict[str, DataFrame]:
    return {name: silver_table(name, bronze[name], salt=salt) for name in SOURCES}


def row_counts(tables: Mapping[str, DataFrame], label: str, value: str) -> DataFrame:
    """One row per table: its name and its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias(value)).select(F.lit(name).alias(label), value)
        for name, df in tables.items()
    ]
    union = counts[0]
    for df in counts[1:]:
        union = union.unionByName(df)
    return union
