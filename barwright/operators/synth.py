"""Reproducible synthetic daily bars: a seeded random walk per symbol."""

from __future__ import annotations

import datetime
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright.functions import draws
from barwright.operators.calendar import business_day_number, first_business_day
from barwright.operators.quality import row_checks
from barwright.session import path_exists, remove

# Fixed values of the random walk.
DRIFT, VOLATILITY = 0.0002, 0.02
GAP_STDDEV = 0.002
SPREAD_MEAN, SPREAD_STDDEV = 0.003, 0.003
VOLUME_LOW, VOLUME_HIGH = 500_000, 10_000_000
FIRST_PRICE, PRICE_STEP = 100.0, 0.5
DAYS_PER_SYMBOL = 5000

CSV_COLUMNS = ["date", "open", "high", "low", "close", "volume", "symbol"]


def numbered_symbols(spark: SparkSession, count: int) -> DataFrame:
    """SYM0001, SYM0002, ... with start prices 100.0, 100.5, ..."""
    number = F.col("id")
    return spark.range(count).select(
        F.format_string("SYM%04d", number + 1).alias("symbol"), start_price(number))


def start_price(number: Column) -> Column:
    return (F.lit(FIRST_PRICE) + F.lit(PRICE_STEP) * number).alias("start_price")


def synth_bars(symbols: DataFrame, days: int = DAYS_PER_SYMBOL,
               start: str | datetime.date = "2000-01-03", seed: int = 42,
               partitions: int | None = None) -> DataFrame:
    """``days`` business-day bars for each row (symbol, start_price) of ``symbols``.

    The symbols are spread over ``partitions`` tasks first and expanded to days there, so the
    shuffle moves one row per symbol and the window needs none of its own. The number is explicit
    since AQE would size the tasks by the rows before the expansion.
    """
    spark = symbols.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    here = [F.col("symbol"), F.col("i")]
    change = draws.normal(DRIFT, VOLATILITY, seed, "change", *here)
    gap = draws.normal(0.0, GAP_STDDEV, seed, "gap", *here)
    spread = F.abs(draws.normal(SPREAD_MEAN, SPREAD_STDDEV, seed, "spread", *here))
    days_ = (symbols
             .repartition(partitions, "symbol")
             .withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
             .withColumns({"change": change, "gap": gap, "spread": spread}))
    return walk(days_).select(
        "symbol",
        business_day_number(first_business_day(start), F.col("i")).alias("dt"),
        "open", "high", "low", "close",
        draws.integer(VOLUME_LOW, VOLUME_HIGH, seed, "volume", *here).alias("volume"),
    )


def walk(days: DataFrame) -> DataFrame:
    """Prices in cents for days ``i`` of a symbol, from its ``start_price`` and the day's ``change``,
    ``gap`` and ``spread``: a close is the one before times 1 + change, an open the close before times
    1 + gap, and high and low lie a spread outside of both."""
    series = Window.partitionBy("symbol").orderBy("i")
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    closed = days.withColumn(
        "close", F.col("start_price") * F.product(1 + F.col("change")).over(so_far))
    opened = closed.withColumn("open", F.coalesce(
        F.lag("close").over(series) * (1 + F.col("gap")),
        F.col("close") / (1 + F.col("change"))))
    cents = {
        "open": F.col("open"),
        "high": F.greatest("open", "close") * (1 + F.col("spread")),
        "low": F.least("open", "close") * (1 - F.col("spread")),
        "close": F.col("close"),
    }
    return opened.withColumns({name: F.round(value, 2).cast("decimal(18,2)")
                               for name, value in cents.items()})


def generate_bars(spark: SparkSession, rows: int | None = None, num_symbols: int = 200,
                  days: int = DAYS_PER_SYMBOL, start: str | datetime.date = "2000-01-03",
                  seed: int = 42) -> DataFrame:
    """Bars for numbered symbols. ``rows`` asks for at least that many, 5000 days per symbol."""
    if rows:
        days = DAYS_PER_SYMBOL
        num_symbols = math.ceil(rows / days)
    return synth_bars(numbered_symbols(spark, num_symbols), days, start, seed)


def write_csv(bars: DataFrame, path: str, split_rows: int = 0) -> None:
    """CSV files with a header each; ``split_rows`` limits the rows of one file.

    The many files of a split are moved into place by the tasks that wrote them (the committer's
    algorithm 2), since the driver would move one after the other. A repeated task replaces its files, and
    those of a write that fails are removed.
    """
    text = bars.withColumn("date", F.date_format("dt", "yyyy-MM-dd")).select(*CSV_COLUMNS)
    writer = text.write.option("header", True)
    if not split_rows:
        writer.csv(path)
        return
    spark = bars.sparkSession
    there = path_exists(spark, path)
    try:
        writer.option("maxRecordsPerFile", split_rows).option(
            "mapreduce.fileoutputcommitter.algorithm.version", "2").csv(path)
    except Exception:
        if not there:
            remove(spark, path)
        raise


def profile(bars: DataFrame) -> DataFrame:
    """Per symbol: size, date span, and counts of rows that break what the generator promises."""
    outside = (F.col("volume") < VOLUME_LOW) | (F.col("volume") >= VOLUME_HIGH)
    return bars.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("dt").alias("first_dt"),
        F.max("dt").alias("last_dt"),
        F.count_if(F.weekday("dt") >= 5).alias("weekend_rows"),
        F.count_if(row_checks()["ohlc_is_inconsistent"]).alias("ohlc_violations"),
        F.count_if(outside).alias("volume_out_of_range"),
    )
