"""Folders of the lake, and how each is written and read.

    bronze/<source>/ingested_date=/run_id=/batch=   append-only batches
    silver/<table>/slot=/bucket=                    parts of Silver (see ``parts``)
    warehouse/<object>/slot=/...                    parts of facts, dimensions, mart states
    changes/<table>/slot=                           rows of Silver before and after a run
    versions/<layer>/<slot>                         which parts an attempt's version has
    log/<name>                                      small append-only tables

Parquet folders cannot be swapped in one step, so every attempt of a run writes a slot
of its own, is judged on the version made with it, and then publishes Silver, warehouse
and ledger by one file in the publish log. A run that fails, or a driver lost on the
way, leaves what is live as it was. Publications are numbered, and each names the one it
builds on by taking the next number: of two runs that began at the same publication the
second is refused. Slots stay readable after the next publication; whoever owns the lake
removes those that neither the live version nor its longest reader names.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date, datetime
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions import utc_timestamps
from shopledger.operators import checksums, same_rows
from shopledger.schemas import (
    EVENT_SOURCE,
    FACT_TABLES,
    PRIMARY_KEYS,
    PUBLISH_LOG_SCHEMA,
    REJECTED_RECORD,
    SILVER_SCHEMAS,
    SOURCE_SCHEMAS,
    WAREHOUSE_SCHEMAS,
)
from shopledger.session import shuffles_released
from shopledger.sources.parts import BUCKET, PartTable, Version, bucket_of

PARALLEL_WRITES = 6
_PRINT = "_print"


class PublishError(RuntimeError):
    """Silver cannot be published."""


class StaleBaseError(PublishError):
    """Another run has published since this one began."""


@dataclass(frozen=True)
class Lake:
    """``buckets`` is the number of parts of each Silver table and mart state of a new
    lake: about one per few GB of the largest. A lake keeps the number it was begun with."""

    root: str
    buckets: int = 16

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    def bronze(self, source: str) -> str:
        return self._at("bronze", source)

    def silver(self, table: str) -> PartTable:
        return PartTable(table, self._at("silver", table), SILVER_SCHEMAS[table])

    def warehouse(self, name: str, schema: T.StructType | None = None) -> PartTable:
        """A fact, cut by its date, or another object of the warehouse, cut by buckets."""
        part = "date_key" if name in FACT_TABLES else BUCKET
        return PartTable(name, self._at("warehouse", name), schema or WAREHOUSE_SCHEMAS[name], part)

    def changes(self, table: str, slot: str) -> str:
        return self._at("changes", table, f"slot={slot}")

    def version(self, layer: str, slot: str) -> str:
        return self._at("versions", layer, slot)

    def log(self, name: str) -> str:
        return self._at("log", name)


def in_parallel(spark: SparkSession, job: Callable[[str], dict], names: Iterable[str]) -> list[dict]:
    """Run one independent Spark job per name from a few driver threads, so the
    tail of one write overlaps the next. Results keep the order of the names."""
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        return list(pool.map(inheritable_thread_target(spark)(job), names))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a schema. Bronze batches are written with declared
    types, never inferred ones: a batch with short decimals or an all-null column
    would otherwise be unreadable next to the others."""
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields))


_BATCH_COLUMNS = ("ingested_date", "run_id", "batch")
_REJECTED = "rejected-"


def _bronze_schema(source: str) -> T.StructType:
    kinds = {"ingested_date": T.DateType()}
    return T.StructType(
        [*SOURCE_SCHEMAS[source].fields, *(T.StructField(c, kinds.get(c, T.StringType())) for c in _BATCH_COLUMNS)]
    )


def append_bronze(
    batch: DataFrame, lake: Lake, source: str, *, run_id: str, ingested_date: date, batch_id: str | None = None
) -> dict:
    """Write one batch and report its rows and newest ``updated_at``, observed
    in the same pass. An empty batch writes no file. Batches only ever add: a run
    repeated under its own id, after the watermark has moved, keeps what its first
    attempt wrote, and Silver takes rows that came twice as one.

    Rows of the feed with a ``rejected_record`` go, in the same pass, to a batch next to it that only
    ``read_rejected`` reads."""
    batch_id = batch_id or new_slot(source)
    seen = Observation()
    schema = SOURCE_SCHEMAS[source]
    if source == EVENT_SOURCE and REJECTED_RECORD in batch.columns:
        schema = T.StructType([*schema.fields, T.StructField(REJECTED_RECORD, T.StringType())])
        bad = F.col(REJECTED_RECORD).isNotNull()
    else:
        bad = F.lit(False)
    (
        conform(utc_timestamps(batch), schema)
        .observe(
            seen,
            F.count_if(~bad).alias("rows"),
            F.max("updated_at").alias("newest"),
            F.count_if(bad).alias("rejected"),
        )
        .withColumns(
            {
                "ingested_date": F.lit(ingested_date),
                "run_id": F.lit(run_id),
                "batch": F.when(bad, F.lit(f"{_REJECTED}{batch_id}")).otherwise(batch_id),
            }
        )
        .sortWithinPartitions("updated_at")
        .write.mode("append")
        .partitionBy(*_BATCH_COLUMNS)
        .parquet(lake.bronze(source))
    )
    return seen.get


def has_parquet(spark: SparkSession, path: str) -> bool:
    """Whether the folder holds a Parquet file. Lists, opens nothing."""
    try:
        return not parquet_files(spark, path).limit(1).isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of every Parquet file below a folder, from the listing:
    the file content is a column that is not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )


def read_bronze(spark: SparkSession, lake: Lake, source: str) -> DataFrame:
    """Every batch of a source. ``ingested_date`` and ``run_id`` are partition
    columns, so a filter on them prunes folders."""
    path = lake.bronze(source)
    if not has_parquet(spark, path):
        raise FileNotFoundError(f"Source {source!r} has no batch in Bronze yet ({path})")
    batches = spark.read.schema(_bronze_schema(source)).option("pathGlobFilter", "*.parquet").parquet(path)
    # Only the feed has records that cannot be read.
    return batches.where(~F.col("batch").startswith(_REJECTED)) if source == EVENT_SOURCE else batches


def read_rejected(spark: SparkSession, lake: Lake, source: str) -> DataFrame:
    """The records of a source that were set aside: rejected_record with the columns
    of its batch. Other batches are pruned by their folders."""
    schema = T.StructType([T.StructField(REJECTED_RECORD, T.StringType()), *_bronze_schema(source).fields[-len(_BATCH_COLUMNS) :]])
    try:
        batches = spark.read.schema(schema).option("pathGlobFilter", "*.parquet").parquet(lake.bronze(source))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return batches.where(F.col("batch").startswith(_REJECTED))


def read_batches(spark: SparkSession, lake: Lake, source: str, folders: Iterable[str]) -> DataFrame:
    """The rows of some batches, by their folders below the source's; other batches
    are neither listed nor read."""
    root = lake.bronze(source)
    paths = [f"{root}/{folder}" for folder in folders]
    if not paths:
        return spark.createDataFrame([], _bronze_schema(source))
    return spark.read.schema(_bronze_schema(source)).option("basePath", root).parquet(*paths)


def write_table(df: DataFrame, path: str, *measures: Column, compression: str | None = None) -> dict:
    """Overwrite a folder; the row count and any other measures are observed
    while writing, so the table is evaluated once. ``compression`` is the session's
    unless given."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
    observed.write.mode("overwrite").parquet(path, compression=compression)
    return seen.get


def written(spark: SparkSession, tables: Mapping[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The tables, written to a folder and read back: each is computed once,
    however often the result is used, and its lineage ends at the files. What a write
    shuffled is given up when it ends."""
    with shuffles_released(spark):
        in_parallel(spark, lambda name: write_table(tables[name], f"{folder}/{name}", compression="zstd"), list(tables))
    return {
        name: spark.read.schema(df.schema).parquet(f"{folder}/{name}")
        for name, df in tables.items()
    }


def stage_silver(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    lake: Lake,
    slot: str,
    *,
    batches: Iterable[tuple[str, str]] = (),
    measures: Callable[[str], Mapping[str, Column]] = lambda table: {},
    prints: dict[str, dict] | None = None,
    gathered: bool = False,
) -> Version:
    """Write all Silver tables whole to a slot, and the version they make. ``measures``
    of a table are aggregates observed while it is written; so is its fingerprint, for
    the caller that gives ``prints`` to take it. ``gathered`` tables come from files of one
    of these buckets each and are not shuffled."""

    def write(name: str) -> dict:
        wanted = [c.alias(m) for m, c in measures(name).items()]
        if prints is not None:
            wanted.append(F.struct(*checksums(silver[name].columns)).alias(_PRINT))
        cut = silver[name].withColumn(BUCKET, bucket_of(PRIMARY_KEYS[name], lake.buckets))
        return lake.silver(name).write(cut, slot, *wanted, gathered=gathered)

    version = Version(slot, lake.buckets, batches=frozenset(batches))
    for name, seen in zip(silver, in_parallel(spark, write, list(silver))):
        if prints is not None:
            prints[name] = seen.pop(_PRINT).asDict()
        version = version.with_parts(name, (), lake.silver(name).written(spark, slot)).with_measures(name, seen)
    version.save(spark, lake.version("silver", slot))
    return version


def load_version(spark: SparkSession, lake: Lake, layer: str, slot: str) -> Version:
    return Version.load(spark, lake.version(layer, slot))


def read_silver(spark: SparkSession, lake: Lake, slot: str | Version) -> dict[str, DataFrame]:
    version = slot if isinstance(slot, Version) else load_version(spark, lake, "silver", slot)
    return {name: version.read(spark, lake.silver(name)) for name in SILVER_SCHEMAS}


def read_log(spark: SparkSession, lake: Lake, name: str, schema: T.StructType) -> DataFrame:
    """A log table; empty before its first row was written."""
    try:
        return spark.read.schema(schema).parquet(lake.log(name))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def append_log(spark: SparkSession, lake: Lake, name: str, rows: list[dict], schema: T.StructType) -> None:
    """Append rows to a log. Jobs that run at the same time must not append to
    the same folder: they would share its temporary files."""
    values = [tuple(row.get(field) for field in schema.fieldNames()) for row in rows]
    spark.createDataFrame(values, schema).coalesce(1).write.mode("append").parquet(lake.log(name))


def publications(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per published layer; the number rises with each commit."""
    try:
        return spark.read.schema(PUBLISH_LOG_SCHEMA).json(lake.log("publications"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], PUBLISH_LOG_SCHEMA)


def newest_number(spark: SparkSession, lake: Lake) -> int:
    """Number of the last commit; 0 before the first."""
    return publications(spark, lake).agg(F.max("number")).first()[0] or 0


def live_publication(spark: SparkSession, lake: Lake, layer: str) -> dict | None:
    """Newest publication of a layer (run and slot); None before the first."""
    rows = publications(spark, lake).where(F.col("layer") == layer)
    row = rows.orderBy(F.desc("number")).first()
    return row.asDict() if row else None


def live_slot(spark: SparkSession, lake: Lake, layer: str) -> str | None:
    published = live_publication(spark, lake, layer)
    return published["slot"] if published else None


def live_version(spark: SparkSession, lake: Lake, layer: str) -> Version | None:
    slot = live_slot(spark, lake, layer)
    return None if slot is None else load_version(spark, lake, layer, slot)


def new_slot(run_id: str) -> str:
    """A folder name no other attempt has, of this run or another."""
    return f"{run_id}-{uuid.uuid4().hex[:12]}"


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its whole content, unless there is one of that name: then
    False. The file system's own rename decides, which refuses an existing target;
    HDFS and its like do that atomically."""
    jvm, settings = spark._jvm, spark._jsc.hadoopConfiguration()
    paths = jvm.org.apache.hadoop.fs
    target = paths.Path(path)
    target = target.getFileSystem(settings).makeQualified(target)
    pending = paths.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    out = pending.getFileSystem(settings).create(pending, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.NONE
    try:
        paths.FileContext.getFileContext(target.toUri(), settings).rename(pending, target, options)
    except Py4JJavaError as error:
        pending.getFileSystem(settings).delete(pending, False)
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def publish_slots(
    spark: SparkSession,
    lake: Lake,
    slots: Mapping[str, str],
    *,
    run_id: str,
    at: datetime,
    base: int,
    loaded: Mapping[str, int] | None = None,
) -> int:
    """Make slots live, by layer, in one commit that builds on commit ``base``; its
    number. Refused if another commit has built on that one. ``loaded`` are the row
    counts of the facts when the warehouse is among the layers."""
    lines = []
    for layer, slot in slots.items():
        counts = loaded if loaded and layer == "warehouse" else {}
        row = {
            "number": base + 1,
            "layer": layer,
            "run_id": run_id,
            "slot": slot,
            "published_at": at.isoformat(),
            "fact_sales_rows": counts.get("fact_sales_rows"),
            "fact_campaign_rows": counts.get("fact_campaign_rows"),
        }
        lines.append(json.dumps(row) + "\n")
    if not create_once(spark, f"{lake.log('publications')}/{base + 1:012d}.json", "".join(lines)):
        raise StaleBaseError(
            f"Run {run_id} builds on publication {base}, which another run has built on since."
        )
    return base + 1


def silver_file_plan(spark: SparkSession, lake: Lake, slot: str) -> dict[str, DataFrame]:
    """Files of each Silver table that a publication would copy. Changes
    nothing; a table without files, or with a part that lost them, is an error that
    names it."""
    version = load_version(spark, lake, "silver", slot)
    plan = {}
    for table in SILVER_SCHEMAS:
        parts, at = version.parts.get(table, {}), lake.silver(table)
        # Parts of one slot lie below one folder.
        held = [
            parquet_files(spark, at.folder(s)).where(
                F.regexp_extract("path", rf"/{at.part}=(\d+)/", 1).isin([str(v) for v, own in parts.items() if own == s])
            )
            for s in sorted(set(parts.values()))
            if has_parquet(spark, at.folder(s))
        ]
        if not held:
            raise PublishError(f"Nothing to publish for {table!r}: {at.root} holds no Parquet file of slot {slot}")
        plan[table] = reduce(DataFrame.unionByName, held)
    return plan


def publish_plan(spark: SparkSession, lake: Lake, slot: str) -> DataFrame:
    """One row per Silver table: number of files and bytes to copy."""
    plan = silver_file_plan(spark, lake, slot)
    result = None
    for table, files in plan.items():
        row = files.agg(
            F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")
        ).select(F.lit(table).alias("table_name"), "files", "bytes")
        result = row if result is None else result.unionByName(row)
    return result


def copy_silver(spark: SparkSession, lake: Lake, slot: str, target: Lake, target_slot: str) -> Version:
    """Copy a Silver version whole into a slot of another lake. Both are read again and
    must hold the same rows."""
    silver_file_plan(spark, lake, slot)
    version = load_version(spark, lake, "silver", slot)
    tables = read_silver(spark, lake, version)
    copied = stage_silver(spark, tables, target, target_slot, gathered=version.buckets == target.buckets)
    there = read_silver(spark, target, copied)

    def compare(name: str) -> dict:
        return same_rows(tables[name], there[name]).first().asDict()

    for name, found in zip(tables, in_parallel(spark, compare, list(tables))):
        if not found["same"]:
            raise PublishError(
                f"The copy of {name!r} differs: {found['first_rows']} rows here, {found['second_rows']} there"
            )
    return copied
