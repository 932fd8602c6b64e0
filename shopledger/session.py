"""Session settings the library relies on. No master is set here."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from shopledger.operators import input_bytes

# Runtime settings that results depend on: dates are taken in UTC, and Bronze
# and Silver files carry microsecond timestamps instead of INT96.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session made elsewhere."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="shopledger-shared-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder for tables written within a job, in the place the cluster
    names for checkpoints. A session on one machine that names none gets a folder
    of this machine; a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/shopledger-{uuid.uuid4().hex}"


# Scanned bytes per shuffle partition. Columnar files grow several times when
# decoded, and a sort of a few GB spills without harm, so this stays well below
# executor memory; the upper bound keeps the number of shuffle blocks in check.
BYTES_PER_PARTITION = 256 * 1024**2
MOST_PARTITIONS = 40_000


@contextmanager
def sized_shuffles(spark: SparkSession, *inputs: DataFrame, most: int = MOST_PARTITIONS) -> Iterator[None]:
    """Raise ``spark.sql.shuffle.partitions`` to suit the largest input, up to
    ``most``, while the block runs. AQE merges partitions that turn out small, but
    it cannot make more of them than the setting says. The setting is the session's:
    run one block at a time in a session."""
    name = "spark.sql.shuffle.partitions"
    before = int(spark.conf.get(name))
    largest = max((input_bytes(df) or 0 for df in inputs), default=0)
    wanted = min(largest // BYTES_PER_PARTITION, most)
    spark.conf.set(name, str(max(before, wanted)))
    try:
        yield
    finally:
        spark.conf.set(name, str(before))


_RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """While the block runs, the shuffle files of a statement go as soon as it ends, not
    when the driver happens to collect its garbage: of a job of many statements, only those
    that run hold disk. For statements that run once, as writes do; a DataFrame that is
    collected again would make them anew. The setting is the session's."""
    before = spark.conf.get(_RELEASE, "false")
    spark.conf.set(_RELEASE, "true")
    try:
        yield
    finally:
        spark.conf.set(_RELEASE, before)


# Scanned bytes behind one task of a query that sorts whole rows more than once in a
# stage: 4 MiB of the items' files are some 230,000 rows, of which each sort and hash
# table holds about 200 bytes.
BYTES_PER_TASK = 4 * 1024**2
# The most a task reads of files and of merged shuffle partitions; rows grow about
# tenfold when decoded.
_MOST_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 * 1024**2,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 * 1024**2,
}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def bound_tasks(spark: SparkSession, *inputs: DataFrame, most: int = MOST_PARTITIONS) -> SparkSession:
    """Let the number of tasks grow with the largest input, so that the memory of one does
    not. The number of partitions that shuffles begin with is never below
    ``spark.sql.shuffle.partitions``, and AQE merges those that turn out small; sizes
    the session has set lower stay. The settings are the session's and stay, as queries
    run after they are made."""
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    largest = max((input_bytes(df) or 0 for df in inputs), default=0)
    spark.conf.set(_INITIAL, str(max(before, min(-(-largest // BYTES_PER_TASK), most))))
    for name, size in _MOST_BYTES.items():
        if _bytes(spark.conf.get(name)) > size:
            spark.conf.set(name, f"{size}b")
    return spark


def _bytes(text: str) -> int:
    """Bytes of a Spark size such as ``128MB``, ``16m`` or ``134217728b``."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]?)[a-z]*", text.strip().lower()).groups()
    return int(number) * 1024 ** " kmgtp".index(unit if unit and unit in "kmgtp" else " ")


def local_session(cores: str = "*", *, shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("shopledger")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="shopledger-catalog-"))
    )
    for name, value in RUNTIME_SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)
