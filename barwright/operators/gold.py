"""Silver to gold: moving averages, average volume and the daily return.

Frames count stored rows of the symbol, not calendar days, and a short frame at the start of a
series averages what there is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barwright.functions.numeric import exact_mean, simple_return
from barwright.schemas import FEATURE_COLUMNS, KEY

# Feature name -> (column averaged, frame length in rows).
FRAMES = {"ma3": ("close", 3), "ma5": ("close", 5), "ma20": ("close", 20), "vol10": ("volume", 10)}

# A row is read by its own frames and by those of the next HALO rows of its symbol.
HALO = max(rows for _, rows in FRAMES.values()) - 1


def _with_features(silver: DataFrame, series: WindowSpec) -> DataFrame:
    """The feature columns over ``series``.

    A frame's sum is the running sum less the running sum of as many rows ago. Decimal sums are
    exact, so that equals summing each frame anew, at one addition a row instead of 38.
    """
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = silver.withColumns({
        "_rows": F.row_number().over(series),
        "_previous": F.lag("close").over(series),
        # A digit less than the sum may have, so that the difference below keeps them all.
        "_close": F.sum("close").over(so_far).cast("decimal(37,8)"),
        # A sum of longs could overflow; this one cannot.
        "_volume": F.sum(F.col("volume").cast("decimal(19,0)")).over(so_far),
    })
    means = {}
    for name, (column, rows) in FRAMES.items():
        before = F.coalesce(F.lag(f"_{column}", rows).over(series), F.lit(0))
        means[name] = exact_mean(F.col(f"_{column}") - before, F.least("_rows", F.lit(rows)))
    return running.withColumns({
        **means, "ret1d": simple_return(F.col("close"), F.col("_previous")),
    })


def gold_features(silver: DataFrame, carry: list[str] = (),
                  series: list[str] = ("symbol",), unique: bool = False) -> DataFrame:
    """All features from one shuffle and one sort by (symbol, dt); ``carry`` names columns to keep,
    and ``series`` the columns whose values make a series of their own. With ``unique`` a date that
    a series repeats fails the job; repeated dates are neighbours, so that takes no pass of its own.

    Silver has one row per symbol and date, so the calendar bounds the rows of a symbol (about 250
    a year) whatever the size of the table. Where even that is too long for one task, use
    :func:`gold_features_chunked`.
    """
    window = Window.partitionBy(*series).orderBy("dt")
    own = [name for name in series if name not in KEY and name not in carry]
    rows = silver.select(*KEY, "close", "volume", *own, *carry)
    if not unique:
        return _with_features(rows, window).select(*KEY, *FEATURE_COLUMNS, *carry)
    found = _with_features(rows.withColumn("_before", F.lag("dt").over(window)), window)
    stop = F.raise_error(F.concat(F.lit("key is repeated: "), F.to_json(F.struct(*KEY))))
    symbol = F.when(F.col("_before") == F.col("dt"), stop.cast("string")) \
        .otherwise(F.col("symbol"))
    return found.select(symbol.alias("symbol"), "dt", *FEATURE_COLUMNS, *carry)


def gold_features_chunked(silver: DataFrame, chunk_rows: int = 2048) -> DataFrame:
    """The same rows as :func:`gold_features`, with no task holding a whole symbol.

    Each row gets its position in the symbol from the row counts of earlier years. Positions are
    cut into chunks, the last ``HALO`` rows of a chunk also go to the next one, and the windows run
    per (symbol, chunk). Positions count rows, so gaps in the dates do not matter. The offsets have
    a row per symbol and year. ``silver`` is read twice and should be a stored table.
    """
    if chunk_rows <= HALO:
        raise ValueError(f"chunk_rows must exceed {HALO}")
    bars = silver.select(*KEY, "close", "volume").withColumn("_year", F.year("dt"))
    years = Window.partitionBy("symbol").orderBy("_year")
    offsets = bars.groupBy("symbol", "_year").agg(F.count(F.lit(1)).alias("_in_year")).select(
        "symbol", "_year",
        F.coalesce(
            F.sum("_in_year").over(years.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0),
        ).alias("_offset"))
    in_year = F.row_number().over(Window.partitionBy("symbol", "_year").orderBy("dt"))
    position = F.col("_offset") + F.col("_in_year") - 1
    chunk = F.floor(F.col("_position") / chunk_rows)
    reaches_next = F.col("_position") % chunk_rows >= chunk_rows - HALO
    placed = (bars
              .withColumn("_in_year", in_year)
              .join(offsets, ["symbol", "_year"])
              .withColumn("_position", position)
              .withColumn("_home", chunk)
              .withColumn("_chunk", F.explode(
                  F.when(reaches_next, F.array("_home", F.col("_home") + 1))
                  .otherwise(F.array("_home")))))
    series = Window.partitionBy("symbol", "_chunk").orderBy("dt")
    return _with_features(placed, series) \
        .where(F.col("_chunk") == F.col("_home")) \
        .select(*KEY, *FEATURE_COLUMNS)
