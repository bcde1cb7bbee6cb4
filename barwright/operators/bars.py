"""Roll-up of intraday rows to one bar per symbol and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.schemas import BARS, BAR_COLUMNS

_PRICE = BARS["open"].dataType


def bar_aggregates(order: str, opened: str = "price", high: str = "price", low: str = "price",
                   closed: str = "price", size: str = "size") -> list[Column]:
    """Open, high, low, close and volume of a group, first and last by ``order``.

    All buffers are fixed-width, so Spark aggregates by hash and map-side first; a group of any
    size is one row per map task in the shuffle.
    """
    return [
        F.min_by(opened, order).cast(_PRICE).alias("open"),
        F.max(high).cast(_PRICE).alias("high"),
        F.min(low).cast(_PRICE).alias("low"),
        F.max_by(closed, order).cast(_PRICE).alias("close"),
        F.sum(size).cast("long").alias("volume"),
    ]


def daily_bars(ticks: DataFrame, ts: str = "ts", order: str = "seq", **columns: str) -> DataFrame:
    """One bar per symbol and calendar day from trades. ``order`` must not tie inside a day.

    ``columns`` renames the inputs of :func:`bar_aggregates`.
    """
    return (ticks
            .groupBy("symbol", F.to_date(ts).alias("dt"))
            .agg(*bar_aggregates(order, **columns))
            .select(*BAR_COLUMNS))


def roll_up(intraday: DataFrame, ts: str = "ts", order: str = "seq") -> DataFrame:
    """One bar per symbol and calendar day from bars of shorter intervals."""
    return daily_bars(intraday, ts, order, opened="open", high="high", low="low", closed="close",
                      size="volume")
