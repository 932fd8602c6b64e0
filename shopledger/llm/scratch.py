"""Tables written within a job, in the folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

from shopledger.session import shuffles_released


@cache
def _test_folder() -> str:
    return tempfile.mkdtemp(prefix="llm-scratch-")


def shared_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. A session on one machine that
    names none, as in tests, gets a folder of this machine; a cluster must name one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local["):
        return _test_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of Parquet files: its work is done once, and a lost
    executor costs only the tasks that read it. Its shuffle files go when it is written."""
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm-{name}-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
