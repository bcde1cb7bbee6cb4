"""What readers of gold ask for: the newest rows, and the size of each layer."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.schemas import KEY


def latest_date(rows: DataFrame) -> DataFrame:
    return rows.groupBy("symbol").agg(F.max("dt").alias("dt"))


def latest_features(gold: DataFrame) -> DataFrame:
    """Rows dated at their symbol's last date, as a semi join.

    Its build side has one row per symbol; AQE broadcasts it when it is measured to be small.
    """
    return gold.join(latest_date(gold), KEY, "left_semi").select(*gold.columns)


def latest_ranked(gold: DataFrame) -> DataFrame:
    """The same rows from a single scan: ``rank`` keeps ties, as the semi join does.

    Better when symbols are too many to broadcast: each map task passes on only its newest row per
    symbol, where a shuffled semi join moves all of gold.
    """
    newest = F.rank().over(Window.partitionBy("symbol").orderBy(F.col("dt").desc()))
    return gold.withColumn("_rank", newest).where(F.col("_rank") == 1).drop("_rank")


def layer_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """One row per layer: its name and its number of rows."""
    counts = None
    for name, rows in layers.items():
        one = rows.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
        counts = one if counts is None else counts.unionByName(one)
    return counts
