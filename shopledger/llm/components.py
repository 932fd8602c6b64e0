"""Connected components of links, by alternating large and small stars.

The method of Kiveris et al., "Connected Components in MapReduce and Beyond"
(2014): each round hangs neighbours on their smallest neighbour. A centre with
very many links costs one partial minimum per map task, not one big group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.llm.scratch import written


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _summary(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)).alias("h"),
    ).first()
    return row["n"], row["h"]


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """``node`` and ``component`` for every node that has a link to another;
    the component is its smallest node. Links with a null end, loops and repeated
    links are as if absent. Nodes without links are not in the result."""
    edges = written(
        links.select(
            F.greatest(left, right).cast("long").alias("u"), F.least(left, right).cast("long").alias("v")
        )
        .where(F.col(left).isNotNull() & F.col(right).isNotNull() & (F.col("u") != F.col("v")))
        .distinct(),
        "links",
    )
    before = _summary(edges)
    while True:
        # Large star: every neighbour greater than u hangs on u's smallest.
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = _minima(both).withColumn("m", F.least("m", "u"))
        large = (
            both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        # Small star: u and its smaller neighbours hang on the smallest of them.
        least = _minima(large)
        small = (
            large.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where(F.col("u") != F.col("v"))
            .distinct()
        )
        edges = written(small, "links")
        after = _summary(edges)
        if after == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = after
