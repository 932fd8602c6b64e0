from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from shopledger import session
from shopledger.operators import SkewPolicy, hot_keys, input_bytes, skew, skew_join

POLICY = SkewPolicy(split=True, rows_per_task=20)


def _rows(count, seed, hot_key=None):
    """Half of the rows on one key if asked to, some null keys."""
    rng = random.Random(seed)
    keys = [hot_key if hot_key and rng.random() < 0.5 else rng.choice(["a", "b", "c", None, "d"])
            for _ in range(count)]
    return [(f"r{seed}-{i}", key) for i, key in enumerate(keys)]


def _frames(spark, left, right):
    return (
        spark.createDataFrame(left, "lid string, k string").repartition(4),
        spark.createDataFrame(right, "rid string, k string").repartition(4),
    )


@pytest.mark.parametrize("hot_left, hot_right", [(None, None), ("a", None), (None, "a"), ("a", "a"), ("a", "b")])
def test_same_rows_as_a_plain_join(spark, hot_left, hot_right):
    left, right = _frames(spark, _rows(300, 1, hot_left), _rows(60, 2, hot_right))
    expected = sorted(map(tuple, left.join(right, "k").select("lid", "rid", "k").collect()))
    joined = skew_join(
        left,
        right,
        "k",
        left_hot=hot_keys(left, "k", POLICY),
        right_hot=hot_keys(right, "k", POLICY),
        left_id="lid",
        right_id="rid",
    )
    assert sorted(joined.columns) == ["k", "lid", "rid"]
    assert sorted(map(tuple, joined.select("lid", "rid", "k").collect())) == expected


def test_hot_keys_are_exact(spark):
    df = spark.createDataFrame(
        [("x",)] * 45 + [("y",)] * 20 + [(None,)] * 90 + [("z",)], "k string"
    )
    found = {r["k"]: r["_parts"] for r in hot_keys(df, "k", POLICY).collect()}
    assert found == {"x": 3}


def test_number_of_hot_keys_is_bounded(spark, monkeypatch):
    """Twelve keys of ten rows are hot by size; a share of one in five is not
    reached by any of them, and by at most four keys of anything."""
    rows = [(f"k{i % 12}",) for i in range(120)] + [("big",)] * 60
    df = spark.createDataFrame(rows, "k string")
    policy = SkewPolicy(split=True, rows_per_task=9)
    assert hot_keys(df, "k", policy).count() == 13
    monkeypatch.setattr(skew, "MOST_HOT_KEYS", 5)
    assert [tuple(r) for r in hot_keys(df, "k", policy).collect()] == [("big", 7)]


def test_small_inputs_are_not_counted(spark, tmp_path):
    spark.range(1000).selectExpr("cast(id as string) AS k").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert 0 < input_bytes(df) < 10**6
    assert hot_keys(df, "k", SkewPolicy()) is None
    assert hot_keys(df, "k", POLICY) is not None


def test_hot_rows_are_spread_over_tasks(spark):
    """One key with 9 of 10 rows: no task gets more than a fraction of them."""
    left = spark.range(20_000).select(
        F.concat(F.lit("r"), F.col("id")).alias("lid"),
        F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
    )
    right = left.select("k").distinct().withColumn("rid", F.col("k"))
    hot = hot_keys(left, "k", SkewPolicy(split=True, rows_per_task=500))
    options = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name) for name in options}
    try:
        for name, value in options.items():
            spark.conf.set(name, value)
        joined = skew_join(left, right, "k", left_hot=hot, left_id="lid")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(sizes) == 20_000
    assert max(sizes) < 20_000 / 4


def test_shuffle_partitions_follow_the_input(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    with session.sized_shuffles(spark, df):
        assert spark.conf.get(name) == before
    monkeypatch.setattr(session, "BYTES_PER_PARTITION", 10)
    with pytest.raises(RuntimeError), session.sized_shuffles(spark, df):
        assert int(spark.conf.get(name)) == input_bytes(df) // 10
        raise RuntimeError
    assert spark.conf.get(name) == before


def test_parts_do_not_depend_on_the_attempt(spark):
    """Recomputing a task must not move rows, so no random values in the plan."""
    left, right = _frames(spark, _rows(100, 3, "a"), _rows(10, 4))
    joined = skew_join(left, right, "k", left_hot=hot_keys(left, "k", POLICY), left_id="lid")
    assert "rand" not in joined._jdf.queryExecution().analyzed().toString()
