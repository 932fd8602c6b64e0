from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from shopledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", shuffle_partitions=4)
    # The rows of createDataFrame count as small, so that joins are split for
    # hot keys only where a test asks for it.
    session.conf.set("spark.sql.defaultSizeInBytes", str(64 * 1024**2))
    # Small tables are written by several tasks, as large ones are.
    session.conf.set("spark.sql.adaptive.coalescePartitions.minPartitionSize", "1")
    yield session
    session.stop()
