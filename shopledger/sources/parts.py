"""Tables kept in parts, and versions that share parts.

    <root>/slot=<slot>/<part column>=<value>/*.parquet

A slot is what one attempt of a run wrote: the parts it touched, nothing else. A version
names for every part of every table the slot that holds it, so parts that a run did not
touch are carried over by reference, and an older version stays readable next to a newer
one. Silver and mart states are cut by a hash of their key, facts by their date.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKET = "bucket"

VERSION_SCHEMA = T.StructType(
    [
        T.StructField("entry", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("slot", T.StringType()),
        T.StructField("number", T.LongType()),
    ]
)


def bucket_of(key: str | Iterable[str], buckets: int) -> Column:
    columns = [key] if isinstance(key, str) else list(key)
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class PartTable:
    """A table below ``root`` with the columns of ``schema``, cut by ``part``. A part
    column that is a data column as well is stored in the folder names alone."""

    name: str
    root: str
    schema: T.StructType
    part: str = BUCKET

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def folder(self, slot: str, value: int | None = None) -> str:
        whole = f"{self.root}/slot={slot}"
        return whole if value is None else f"{whole}/{self.part}={value}"

    def write(self, df: DataFrame, slot: str, *measures: Column, gathered: bool = False) -> dict:
        """Write the parts in ``df``, which has the table's columns and the part's. Rows
        of a part are gathered, and a part larger than AQE's advisory size is dealt over
        several tasks, so files are neither many nor unbounded; with ``gathered`` they are
        read from files of one part each, and stay as they lie. Row count and ``measures``
        are observed in the last stage, whose tasks count once each."""
        seen = Observation()
        (
            (df if gathered else df.hint("rebalance", F.col(self.part)))
            .observe(seen, F.count(F.lit(1)).alias("rows"), *measures)
            .write.mode("overwrite")
            .partitionBy(self.part)
            .parquet(self.folder(slot), compression="zstd")
        )
        return seen.get

    def written(self, spark: SparkSession, slot: str) -> list[int]:
        """Parts that a slot holds, from its listing."""
        try:
            files = (
                spark.read.format("binaryFile")
                .option("pathGlobFilter", "*.parquet")
                .option("recursiveFileLookup", "true")
                .load(self.folder(slot))
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        value = F.regexp_extract("path", rf"/{self.part}=(\d+)/[^/]*$", 1)
        found = files.select(value.alias("value")).where("value <> ''").distinct()
        return sorted(int(r["value"]) for r in found.collect())

    def read(
        self, spark: SparkSession, parts: Mapping[int, str], sizes: Mapping[str, int] | None = None
    ) -> DataFrame:
        """The rows of the given parts, each from its slot. The part column is a
        partition column of the scan, so filters and joins on it prune folders. A slot of
        which all parts are asked for, by the numbers of parts in ``sizes``, is listed as one
        folder."""
        columns, sizes = self.columns, sizes or {}
        fields = [f for f in self.schema.fields if f.name != self.part]
        stored = T.StructType(
            [*fields, T.StructField("slot", T.StringType()), T.StructField(self.part, T.IntegerType())]
        )
        if not parts:
            return spark.createDataFrame([], stored).select(*columns)
        wanted = Counter(parts.values())
        whole = {slot for slot, n in wanted.items() if sizes.get(slot) == n}
        folders = [self.folder(slot) for slot in sorted(whole)]
        folders += [self.folder(slot, value) for value, slot in sorted(parts.items()) if slot not in whole]
        return spark.read.schema(stored).option("basePath", self.root).parquet(*folders).select(*columns)


@dataclass(frozen=True)
class Version:
    """What one publication of a layer consists of. Its size follows the number of
    parts and of extracted batches, not the rows.

    ``origin`` is the Silver slot that a Silver version was merged into, or that a
    warehouse version was loaded from; ``changed`` are the tables of which this slot holds
    the rows that the merge changed."""

    slot: str
    buckets: int
    origin: str | None = None
    changed: frozenset[str] = frozenset()
    parts: Mapping[str, Mapping[int, str]] = field(default_factory=dict)
    batches: frozenset[tuple[str, str]] = frozenset()
    measures: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    # Parts that a slot holds in all, live or not, by table.
    sizes: Mapping[str, Mapping[str, int]] = field(default_factory=dict)

    def carried(self, slot: str, origin: str | None) -> Version:
        """The same parts as the beginning of another attempt's version."""
        return replace(self, slot=slot, origin=origin, changed=frozenset())

    def with_parts(self, table: str, replaced: Iterable[int], written: Iterable[int]) -> Version:
        """A table's parts after ``replaced`` ones gave way to those ``written`` in
        this version's slot."""
        gone, written = set(replaced), list(written)
        parts = {v: s for v, s in self.parts.get(table, {}).items() if v not in gone} | {v: self.slot for v in written}
        sizes = {s: n for s, n in self.sizes.get(table, {}).items() if s in set(parts.values())}
        if written:
            sizes[self.slot] = len(written)
        return replace(self, parts={**self.parts, table: parts}, sizes={**self.sizes, table: sizes})

    def read(self, spark: SparkSession, table: PartTable, values: Iterable[int] | None = None) -> DataFrame:
        """A table of this version, or those of its parts that are among ``values``."""
        held = self.parts.get(table.name, {})
        if values is not None:
            held = {v: held[v] for v in values if v in held}
        return table.read(spark, held, self.sizes.get(table.name))

    def with_measures(self, table: str, values: Mapping[str, int]) -> Version:
        return replace(self, measures={**self.measures, table: dict(values)})

    def save(self, spark: SparkSession, path: str) -> None:
        rows = [
            ("layout", None, "buckets", None, self.buckets),
            ("layout", None, "slot", self.slot, None),
            ("layout", None, "origin", self.origin, None),
            *(("changed", t, None, None, None) for t in sorted(self.changed)),
            *(("part", t, str(v), s, None) for t, parts in self.parts.items() for v, s in parts.items()),
            # A table without parts is still a table.
            *(("table", t, None, None, None) for t in self.parts),
            *(("batch", source, batch, None, None) for source, batch in sorted(self.batches)),
            *(("size", t, None, s, n) for t, found in self.sizes.items() for s, n in found.items()),
            *(("measure", t, m, None, n) for t, found in self.measures.items() for m, n in found.items()),
        ]
        spark.createDataFrame(rows, VERSION_SCHEMA).coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Version:
        parts: dict[str, dict[int, str]] = {}
        measures: dict[str, dict[str, int]] = {}
        sizes: dict[str, dict[str, int]] = {}
        batches, changed, layout = set(), set(), {}
        for r in spark.read.schema(VERSION_SCHEMA).parquet(path).collect():
            if r["entry"] == "part":
                parts.setdefault(r["table_name"], {})[int(r["name"])] = r["slot"]
            elif r["entry"] == "table":
                parts.setdefault(r["table_name"], {})
            elif r["entry"] == "batch":
                batches.add((r["table_name"], r["name"]))
            elif r["entry"] == "measure":
                measures.setdefault(r["table_name"], {})[r["name"]] = r["number"]
            elif r["entry"] == "size":
                sizes.setdefault(r["table_name"], {})[r["slot"]] = r["number"]
            elif r["entry"] == "changed":
                changed.add(r["table_name"])
            else:
                layout[r["name"]] = r["number"] if r["name"] == "buckets" else r["slot"]
        return Version(
            layout["slot"],
            layout["buckets"],
            layout["origin"],
            frozenset(changed),
            parts,
            frozenset(batches),
            measures,
            sizes,
        )
