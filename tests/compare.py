"""Row-by-row comparison of a Spark result with DuckDB's answer to the oracle SQL."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = ["events", "lineitem", "orders", "supplier"]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def differences(result, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when names and rows agree; values are compared exactly, types by their Python class."""
    expected = connection.execute(sql)
    names = [column[0] for column in expected.description]
    if sorted(result.columns) != sorted(names):
        return [f"columns {sorted(result.columns)} instead of {sorted(names)}"]
    order = sorted(names)
    theirs = Counter(tuple(row) for row in connection.execute(
        f"SELECT {', '.join(order)} FROM ({sql}) q").fetchall())
    ours = Counter(tuple(row) for row in result.select(*order).collect())
    text = lambda row: tuple((type(v).__name__, str(v)) for v in row)
    ours = Counter({text(row): n for row, n in ours.items()})
    theirs = Counter({text(row): n for row, n in theirs.items()})
    problems = [f"only Spark: {row}" for row in list((ours - theirs).elements())[:3]]
    problems += [f"only DuckDB: {row}" for row in list((theirs - ours).elements())[:3]]
    if problems:
        problems.append(f"{sum(ours.values())} rows against {sum(theirs.values())}")
    return problems
