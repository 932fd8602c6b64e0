from __future__ import annotations

import pytest

from shopledger import session
from shopledger.session import shared_folder
from shopledger.sources.lake import written
from tests.data import silver
from tests.disk import left_behind, shuffle_files


class _Named:
    """A session that names (or does not name) a checkpoint folder."""

    def __init__(self, root):
        self.conf = {"spark.checkpoint.dir": root} if root else {}


def test_shared_folder_is_the_one_the_session_names():
    first, second = (shared_folder(_Named("s3a://bucket/shared/")) for _ in range(2))
    assert first != second
    assert first.startswith("s3a://bucket/shared/shopledger-")
    unnamed = shared_folder(_Named(None))
    assert unnamed.startswith(session._local_folder())


def test_written_tables_end_the_lineage(spark):
    folder, tables = shared_folder(spark), silver(spark)
    copy = written(spark, tables, folder)
    assert {n: df.schema for n, df in copy.items()} == {n: df.schema for n, df in tables.items()}
    assert sorted(map(tuple, copy["order_items"].collect())) == sorted(
        map(tuple, tables["order_items"].collect())
    )
    assert all(folder.rsplit("/", 1)[1] in path for path in copy["order_items"].inputFiles())


def test_written_tables_leave_no_shuffle_files(spark):
    held, tables = shuffle_files(spark), {n: df.distinct() for n, df in silver(spark).items()}
    copy = written(spark, tables, shared_folder(spark))
    assert not left_behind(spark, held)
    assert all(copy[n].count() == tables[n].count() for n in tables)


def test_a_cluster_must_name_the_shared_folder():
    class Cluster:
        conf = {"spark.master": "spark://host:7077"}

    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared_folder(Cluster)


def test_tasks_grow_in_number_and_not_in_size(spark, tmp_path):
    path, name = str(tmp_path / "rows"), "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    scan, merged = "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.range(2_000_000).write.parquet(path)
    df = spark.read.parquet(path)
    size = session.input_bytes(df)
    fresh = spark.newSession()
    fresh.conf.set("spark.sql.shuffle.partitions", "3")
    fresh.conf.set(merged, "1m")
    session.bound_tasks(fresh, df)
    assert fresh.conf.get(name) == str(max(3, -(-size // session.BYTES_PER_TASK)))
    assert session._bytes(fresh.conf.get(scan)) == 16 * 1024**2
    assert fresh.conf.get(merged) == "1m"
    fresh.conf.set("spark.sql.shuffle.partitions", "50")
    session.bound_tasks(fresh, df)
    assert fresh.conf.get(name) == "50"
    assert [session._bytes(x) for x in ("7", "128MB", "16m", "1kb", "2g")] == [7, 128 * 1024**2, 16 * 1024**2, 1024, 2 * 1024**3]


def test_a_query_bounds_its_tasks_by_its_tables(spark, tmp_path, monkeypatch):
    from verification import queries

    seen = []
    monkeypatch.setattr(queries, "bound_tasks", lambda spark, *inputs: seen.append(len(inputs)))
    queries.Sample(spark, "/root/testdata/sf0.001")
    assert seen == [6]
