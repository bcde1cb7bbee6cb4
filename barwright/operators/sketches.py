"""Small summaries that can be merged, in place of scans: quantiles of prices, numbers of keys.

A KLL sketch of a symbol's prices in a month answers for the rank of any price; sketches of the months
of a range merge into that of the range. A HyperLogLog sketch of the keys of a load and month tells
how many different ones there are, also over several loads together. Both are a few kilobytes, whatever
they saw.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.functions.dates import month_key
from barwright.schemas import KEY

# Ranks are within RANK_ERROR of the exact ones with some 99 % at this size of a KLL sketch.
KLL_SIZE, RANK_ERROR = 400, 0.01
# 2^14 registers: numbers of keys are within KEY_ERROR (some two standard deviations).
HLL_BITS, KEY_ERROR = 14, 0.02
# A distribution is compared by its prices at so many ranks, evenly spread: a rank more or less of error.
POINTS = 100
DISTANCE_ERROR = 2 * (RANK_ERROR + 1 / POINTS)


def price_sketches(bars: DataFrame) -> DataFrame:
    """symbol, ym, n_rows and the sketch of the closes of each symbol and month."""
    return bars.groupBy("symbol", month_key(F.col("dt")).alias("ym")).agg(
        F.count("close").alias("n_rows"),
        F.kll_sketch_agg_double(F.col("close").cast("double"), KLL_SIZE).alias("sketch"))


def drift_from_sketches(sketches: DataFrame, ref: Column, cur: Column) -> DataFrame:
    """Per symbol the closes of the months ``ref`` against those of the months ``cur`` (conditions on
    ``ym``): rows, medians, and ``distance``, the largest difference of ranks at any price (0: alike,
    1: apart), within DISTANCE_ERROR. Symbols without rows on either side have no distance."""
    sides = {"ref": ref, "cur": cur}
    merged = sketches.groupBy("symbol").agg(
        *[F.coalesce(F.sum(F.when(here, F.col("n_rows"))), F.lit(0)).alias(f"n_{side}")
          for side, here in sides.items()],
        *[F.kll_merge_agg_double(F.when(here & (F.col("n_rows") > 0), F.col("sketch"))).alias(side)
          for side, here in sides.items()])
    both = (F.col("n_ref") > 0) & (F.col("n_cur") > 0)
    ranks = F.array(*[F.lit((i + 0.5) / POINTS) for i in range(POINTS)])
    points = merged.select(
        "symbol", "n_ref", "n_cur",
        *[F.when(F.col(f"n_{side}") > 0, F.kll_sketch_get_quantile_double(side, F.lit(0.5))).alias(
            f"median_{side}") for side in sides],
        *[F.when(both, F.kll_sketch_get_quantile_double(side, ranks)).alias(side) for side in sides])

    def gap(price: Column) -> Column:
        upto = [F.size(F.filter(side, lambda x: x <= price)) for side in sides]
        return F.abs(upto[0] - upto[1]) / F.lit(POINTS)

    return points.select("symbol", "n_ref", "n_cur", "median_ref", "median_cur", F.array_max(
        F.transform(F.concat("ref", "cur"), gap)).alias("distance"))


def key_sketches(bronze: DataFrame) -> DataFrame:
    """source, batch, ym, n_rows and the sketch of the keys of each load and month."""
    key = F.xxhash64(*KEY)
    return bronze.groupBy("source", "batch", month_key(F.col("dt")).alias("ym")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.hll_sketch_agg(key, HLL_BITS).alias("sketch"))


def duplicate_rate_from_sketches(sketches: DataFrame) -> DataFrame:
    """Per source: rows, about how many different keys, and rows per key."""
    merged = sketches.groupBy("source").agg(
        F.sum("n_rows").alias("n_rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_keys"))
    return merged.withColumn("rows_per_key", F.col("n_rows").cast("double") / F.col("n_keys"))


def in_months(low: int | None, high: int | None) -> Column:
    """The months from ``low`` up to but not including ``high``, as numbers like 202401."""
    sides = [F.col("ym") >= low] if low else []
    sides += [F.col("ym") < high] if high else []
    return reduce(lambda a, b: a & b, sides, F.lit(True))
