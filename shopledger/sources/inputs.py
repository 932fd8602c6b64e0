"""Readers for the source systems: row store, JSON event feed, CSV fixture."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions import utc_timestamps
from shopledger.schemas import (
    EVENT_FEED_SCHEMA,
    REJECTED_RECORD,
    ITEM_FIXTURE_SCHEMA,
    SOURCE_SCHEMAS,
    SOURCE_TABLES,
)


def require_source_table(table: str) -> str:
    """The name itself if it is one of the source tables; anything else is
    refused before it can reach a query."""
    if table not in SOURCE_TABLES:
        raise ValueError(f"No table of the row store is named {table!r}")
    return table


def table_options(
    table: str,
    url: str,
    *,
    updated_between: tuple[datetime, datetime] | None = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
) -> dict[str, str]:
    """JDBC options for a source table. With a time range the read is split over
    ``updated_at``, which the source indexes, so that the row store sees
    ``partitions`` bounded range queries instead of one long cursor."""
    options = {
        "url": url,
        "dbtable": require_source_table(table),
        "fetchsize": str(fetch_rows),
        "pushDownPredicate": "true",
    }
    if updated_between:
        low, high = updated_between
        options |= {
            "partitionColumn": "updated_at",
            "lowerBound": low.isoformat(sep=" "),
            "upperBound": high.isoformat(sep=" "),
            "numPartitions": str(partitions),
        }
    return options


# Ranges of a source read, the one of rows without a time not counted.
READ_RANGES = 16


def zoned_literal(moment: datetime) -> str:
    """A moment as the row store's SQL takes it."""
    return f"CAST('{moment.astimezone(timezone.utc).isoformat(sep=' ')}' AS TIMESTAMP WITH TIME ZONE)"


def quantile_query(
    table: str,
    ranges: int = READ_RANGES,
    *,
    since: datetime | None = None,
    literal: Callable[[datetime], str] = zoned_literal,
) -> str:
    """SQL for the row store: one row of the times that cut its rows, or those after
    ``since``, into ranges of about as many rows each."""
    cuts = ", ".join(
        f"percentile_disc({i / ranges!r}) WITHIN GROUP (ORDER BY updated_at) AS q{i}" for i in range(1, ranges)
    )
    changed = f" WHERE updated_at > {literal(since)}" if since else ""
    return f"SELECT {cuts} FROM {require_source_table(table)}{changed}"


def time_ranges(
    cuts: Sequence[datetime | None], literal: Callable[[datetime], str] = zoned_literal
) -> list[str]:
    """Predicates that every row meets exactly one of, whatever the cuts: ranges of
    ``updated_at`` and the rows without one. Equal cuts make one."""
    at = [literal(c) for c in sorted({c for c in cuts if c is not None})]
    if not at:
        return ["updated_at IS NOT NULL", "updated_at IS NULL"]
    between = [f"updated_at >= {low} AND updated_at < {high}" for low, high in zip(at, at[1:])]
    return [f"updated_at < {at[0]}", *between, f"updated_at >= {at[-1]}", "updated_at IS NULL"]


def read_source_table(
    spark: SparkSession,
    table: str,
    url: str,
    *,
    ranges: int = READ_RANGES,
    since: datetime | None = None,
    **split,
) -> DataFrame:
    """A table of the row store; ``changed_since`` filters are pushed down.

    The row store is asked for quantiles of ``updated_at``, of rows after ``since`` if
    that is the watermark, and then read as that many range queries of like size. With
    ``updated_between`` (see ``table_options``) it is not asked."""
    options = table_options(table, url, **split)
    reader = spark.read.format("jdbc")
    if split or ranges < 2:
        return reader.options(**options).load()
    asked = {k: v for k, v in options.items() if k != "dbtable"} | {"query": quantile_query(table, ranges, since=since)}
    cuts = reader.options(**asked).load().first()
    settings = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(url, options["dbtable"], predicates=time_ranges(cuts), properties=settings)


def read_source_files(spark: SparkSession, table: str, path: str) -> DataFrame:
    """A table exported as Parquet in its source shape."""
    return spark.read.schema(SOURCE_SCHEMAS[table]).parquet(path)


def read_event_feed(spark: SparkSession, path: str, *, keep_rejected: bool = False) -> DataFrame:
    """The campaign feed as JSON lines, times turned from ISO-8601 text to UTC. A
    line that is no such record fails the job that reads it, or, with ``keep_rejected``,
    becomes a row of nulls with the line in ``rejected_record``, which extraction sets
    aside (see ``lake.append_bronze``)."""
    if not keep_rejected:
        return utc_timestamps(spark.read.schema(EVENT_FEED_SCHEMA).option("mode", "FAILFAST").json(path))
    return parsed_events(spark.read.text(path))


def parsed_events(lines: DataFrame) -> DataFrame:
    """Events from JSON lines in the column ``value``. A line is rejected if it is no
    JSON object of the feed's types, has a time that is none, or has no event id."""
    broken = "_broken"
    schema = T.StructType([*EVENT_FEED_SCHEMA.fields, T.StructField(broken, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    events = lines.where(F.trim("value") != "").select("value", F.from_json("value", schema, options).alias("event"))
    times = [c for c in EVENT_FEED_SCHEMA.fieldNames() if c in ("event_timestamp", "updated_at")]
    bad = F.col("event").isNull() | F.col(f"event.{broken}").isNotNull() | F.col("event.event_id").isNull()
    for c in times:
        # Without a time of change a record would never pass a watermark.
        bad = bad | F.col(f"event.{c}").try_cast("timestamp").isNull()
    bad = F.coalesce(bad, F.lit(True))

    def value(column: str):
        held = F.col(f"event.{column}")
        return F.when(~bad, held.try_cast("timestamp") if column in times else held).alias(column)

    return events.select(*(value(c) for c in EVENT_FEED_SCHEMA.fieldNames()), F.when(bad, F.col("value")).alias(REJECTED_RECORD))


def read_item_fixture(spark: SparkSession, path: str) -> DataFrame:
    """Extra order items for the quality gate, from CSV with a header. A value that
    does not fit its column fails the job that reads it."""
    return (
        spark.read.schema(ITEM_FIXTURE_SCHEMA)
        .option("mode", "FAILFAST")
        .option("header", True)
        .option("enforceSchema", False)
        .csv(path)
    )
