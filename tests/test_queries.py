from __future__ import annotations

import pytest

import __spark_entry__ as contract
from verification.compare import connect, differences
from verification.oracle import oracle
from verification.queries import registered

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle_connection():
    return connect(FOLDER)


def test_every_query_has_an_oracle():
    assert registered().keys() == oracle().keys()
    assert registered().keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", registered())
def test_query_equals_oracle(spark, oracle_connection, name):
    result = registered()[name](spark, FOLDER)
    assert differences(result, oracle_connection, oracle()[name]) is None


def test_entry_serves_daily_sales(spark):
    daily = contract.entry(spark)
    assert daily.columns == ["calendar_date", "revenue", "orders", "average_order_value", "units"]
    assert daily.count() > 0
