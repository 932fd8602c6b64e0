"""Shuffle files that a local session holds."""

from __future__ import annotations

import time


def shuffle_files(spark) -> set[str]:
    env = spark._jvm.org.apache.spark.SparkEnv.get()
    files = env.blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def left_behind(spark, before: set[str], seconds: float = 10) -> set[str]:
    """Shuffle files that are there since ``before`` and do not go within some seconds,
    without a garbage collection."""
    until = time.time() + seconds
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    return left
