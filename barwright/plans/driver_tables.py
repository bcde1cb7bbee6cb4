"""Bronze rows derived from the driver's tables (the mappings of FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.operators.silver import cast_bars


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed_rows(events: DataFrame) -> DataFrame:
    """Dirty rows, several per symbol and day, with the event's timestamp kept as ``ts``."""
    priced = events.selectExpr(
        "event_id", "user_id", "ts",
        "CAST(value AS decimal(18,2)) AS p",
        "CAST(CAST(value AS decimal(18,2)) + (event_id % 11) * 0.01 AS decimal(18,2)) AS c",
    )
    return priced.selectExpr(
        "CASE WHEN event_id % 97 = 0 THEN NULL"
        " ELSE concat('U', lpad(CAST(user_id AS string), 4, '0')) END AS symbol",
        "CAST(ts AS date) AS dt",
        "p AS open",
        "CAST(greatest(p, c) + (event_id % 3) * 0.01 AS decimal(18,2)) AS high",
        "CAST(least(p, c) - (event_id % 4) * 0.01 AS decimal(18,2)) AS low",
        "CASE WHEN event_id % 41 = 0 THEN NULL"
        " WHEN event_id % 53 = 0 THEN CAST(0 AS decimal(18,2)) ELSE c END AS close",
        "CASE WHEN event_id % 29 = 0 THEN NULL"
        " WHEN event_id % 31 = 0 THEN CAST(-1 - event_id % 100 AS bigint)"
        " ELSE CAST((event_id * 37) % 10000 AS bigint) END AS volume",
        "event_id AS seq",
        "ts",
    )


def feed_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = feed_rows(table(spark, sf_dir, "events"))
    return cast_bars(rows, F.lit("feed").alias("source"), "seq")


def bulk_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean rows with ties on (symbol, dt, seq)."""
    priced = table(spark, sf_dir, "lineitem").selectExpr(
        "l_suppkey", "l_shipdate", "l_linenumber", "l_quantity", "l_orderkey",
        "CAST(l_extendedprice AS decimal(18,2)) AS p",
    )
    rows = priced.selectExpr(
        "concat('S', lpad(CAST(l_suppkey AS string), 4, '0')) AS symbol",
        "CAST(l_shipdate AS date) AS dt",
        "p AS open",
        "CAST(p + 1 AS decimal(18,2)) AS high",
        "CAST(p - 1 AS decimal(18,2)) AS low",
        "CAST(p + (l_linenumber % 3) - 1 AS decimal(18,2)) AS close",
        "CAST(l_quantity AS bigint) AS volume",
        "l_orderkey * 10 + l_linenumber AS seq",
    )
    return cast_bars(rows, F.lit("bulk").alias("source"), "seq")
