"""Daily bars in event time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barwright.functions.dates import utc_date, utc_instant
from barwright.operators.bars import bar_aggregates
from barwright.schemas import BAR_COLUMNS
from barwright.streaming.topics import start


def streaming_daily_bars(ticks: DataFrame, delay: str = "2 days", ts: str = "ts",
                         order: str = "seq", **columns: str) -> DataFrame:
    """A bar per symbol and UTC day, given out once the watermark has passed the end of the day.

    A ``ts`` without zone is read as UTC, whatever the session's zone. State is one row per symbol and
    open day. Rows older than ``delay`` behind the newest are late
    and not counted, as with any watermark; where late rows must count, stream into silver instead.
    """
    zone_free = isinstance(ticks.schema[ts].dataType, T.TimestampNTZType)
    return (ticks
            .withColumn(ts, utc_instant(F.col(ts)) if zone_free else F.col(ts))
            .withWatermark(ts, delay)
            .groupBy("symbol", F.window(ts, "1 day").alias("day"))
            .agg(*bar_aggregates(order, **columns))
            .withColumn("dt", utc_date(F.col("day.start")))
            .select(*BAR_COLUMNS))


def write_daily_bars(ticks: DataFrame, checkpoint: str, delay: str = "2 days",
                     fmt: str = "parquet", every: str | None = None,
                     **options: str) -> StreamingQuery:
    """Append closed bars to a sink, such as ``path=...`` for files.

    The file sink commits each micro-batch exactly once. For a message broker, name its format and
    options and give :func:`barwright.streaming.topics.encode` the bars of
    :func:`streaming_daily_bars`.
    """
    writer = streaming_daily_bars(ticks, delay).writeStream.outputMode("append")
    return start(writer.format(fmt).options(**options), checkpoint, every)
