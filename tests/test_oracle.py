"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as driver
from barwright.plans.oracle import ORACLE
from barwright.plans.registry import QUERIES
from compare import connect, differences

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= driver.queries().items()
    assert ORACLE.items() <= driver.oracle_sql().items()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    assert differences(result, duck, ORACLE[name]) == []


def test_entry(spark):
    result = driver.entry(spark)
    assert result.columns == ["symbol", "dt", "ma3", "ma5", "ma20", "vol10", "ret1d"]
    assert result.count() == 386 + 5334
