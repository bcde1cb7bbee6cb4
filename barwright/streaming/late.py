"""Daily bars that lose no row: what comes too late for its bar is kept beside the bars.

A stream with a watermark drops rows behind it without a word. Here each micro-batch stores its rows by day
until their day is over, by the same rule: the watermark is the newest time of the micro-batches before,
less ``delay``. A row whose day ended by then is late and goes to ``late_rows``; a day that has ended gets
its bars, and its rows go. Bars, late rows and open days so add up to the input.

Below ``root`` lie ``open_rows`` (folders by day and micro-batch), ``late_rows`` (by micro-batch) and
``stream_bars`` (by day). Each step replaces folders of its own micro-batch or day, and the state keeps
where the last one stood, so a micro-batch that runs again after a failure leaves the same tables.
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barwright.functions.dates import utc_date, utc_instant
from barwright.operators.bars import bar_aggregates
from barwright.schemas import BAR_COLUMNS, BARS, few_rows
from barwright.session import path_exists, remove, staged, subfolders
from barwright.sources.state import change_state, read_state
from barwright.streaming.topics import start

DAY = 86_400_000_000  # microseconds


def days_over(mark: int | None) -> int | None:
    """The last day, as a number, that has ended by the instant ``mark``."""
    return None if mark is None else mark // DAY - 1


def open_days(spark: SparkSession, root: str) -> list[int]:
    epoch = datetime.date(1970, 1, 1)
    return sorted((datetime.date.fromisoformat(f.removeprefix("dt=")) - epoch).days
                  for f in subfolders(spark, f"{root}/open_rows") if f.startswith("dt="))


def _folder(day: int) -> str:
    return f"dt={datetime.date(1970, 1, 1) + datetime.timedelta(days=day)}"


def late_batch(rows: DataFrame, batch: int, root: str, delay_us: int, ts: str = "ts",
               order: str = "seq", **columns: str) -> None:
    """Work one micro-batch in."""
    spark = rows.sparkSession
    zone_free = isinstance(rows.schema[ts].dataType, T.TimestampNTZType)
    instant = utc_instant(F.col(ts)) if zone_free else F.col(ts)
    stood = read_state(spark, root).get("late", {})
    before = stood.get("before" if stood.get("batch") == batch else "newest")
    with staged(rows.withColumn("dt", utc_date(instant)).withColumn("_at", F.unix_micros(instant)),
                "ticks") as ticks:
        newest = ticks.agg(F.max("_at")).first()[0]
        newest = before if newest is None else max(newest, newest if before is None else before)
        over, now_over = (days_over(None if at is None else at - delay_us) for at in (before, newest))
        late = F.lit(False) if over is None else F.unix_date("dt") <= over
        closed = stood.get("closed") == batch
        ticks.where(late).drop("_at").write.mode("overwrite").parquet(f"{root}/late_rows/batch={batch}")
        if not closed:
            ticks.where(~late).drop("_at").withColumn("batch", F.lit(batch)).write.mode(
                "overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "dt", "batch").parquet(f"{root}/open_rows")
        schema = ticks.drop("_at", "dt").schema
    place = {"batch": batch, "before": before, "newest": newest}
    change_state(spark, root, lambda state: state.setdefault("late", {}).update(place))
    ended = [day for day in open_days(spark, root) if now_over is not None and day <= now_over]
    if ended and not closed:
        there = spark.read.schema(schema).option("basePath", f"{root}/open_rows").parquet(
            *[f"{root}/open_rows/{_folder(day)}" for day in ended])
        there.groupBy("symbol", "dt").agg(*bar_aggregates(order, **columns)).select(
            *BAR_COLUMNS).hint("rebalance", "dt").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(f"{root}/stream_bars")
        change_state(spark, root, lambda state: state["late"].update(closed=batch))
    for day in ended:
        remove(spark, f"{root}/open_rows/{_folder(day)}")


def stream_bars_and_late_rows(ticks: DataFrame, root: str, checkpoint: str, delay: datetime.timedelta,
                              every: str | None = None, **names: str) -> StreamingQuery:
    """Keep the bars of closed days below ``root`` up to date, and the rows that came too late for them."""
    writer = ticks.writeStream.foreachBatch(lambda rows, batch: late_batch(
        rows, batch, root, delay // datetime.timedelta(microseconds=1), **names))
    return start(writer, checkpoint, every)


def read_stream_bars(spark: SparkSession, root: str) -> DataFrame:
    if not path_exists(spark, f"{root}/stream_bars"):
        return few_rows(spark, [], BARS)
    return spark.read.schema(BARS).parquet(f"{root}/stream_bars").select(*BAR_COLUMNS)


def read_rows(spark: SparkSession, root: str, name: str, schema: T.StructType) -> DataFrame:
    """``late_rows`` or ``open_rows``, in the columns of the stream."""
    if not path_exists(spark, f"{root}/{name}"):
        return few_rows(spark, [], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(f"{root}/{name}")
