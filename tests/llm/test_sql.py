"""Queries that SQL can express, against DuckDB on the same tables."""

from __future__ import annotations

import duckdb
import pytest
from samples import SF

from barwright.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", list(ORACLE))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    answer = duck.execute(ORACLE[name])
    columns = [c[0] for c in answer.description]
    result = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(result.columns)
    want = sorted(map(str, answer.fetchall()))
    assert sorted(str(tuple(r)) for r in result.select(columns).collect()) == want
