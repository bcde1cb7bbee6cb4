"""Reading and writing streams in whichever format they come.

File folders are the default. For a message broker pass its format and options and wrap the rows
with :func:`decode` and :func:`encode`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from barwright.functions.dates import utc_instant


def read_stream(spark: SparkSession, path: str | None, schema: T.StructType | None,
                fmt: str = "parquet", **options: str) -> DataFrame:
    reader = spark.readStream.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path) if path else reader.load()


def decode(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows from messages whose ``value`` is JSON."""
    return messages.select(F.from_json(F.col("value").cast("string"), schema).alias("row")) \
        .select("row.*")


def without_redeliveries(messages: DataFrame, ts: str, delay: str, *keys: str) -> DataFrame:
    """Messages without those whose ``keys`` came before, as a broker gives some again after a failure.

    State is one entry for each message of the last ``delay`` of event time: the watermark on ``ts``
    lets go of older ones. A repeat that comes later than that passes, and the merge by key behind
    it still counts it once.
    """
    if dict(messages.dtypes)[ts] == "timestamp_ntz":
        messages = messages.withColumn(ts, utc_instant(F.col(ts)))
    return messages.withWatermark(ts, delay).dropDuplicatesWithinWatermark([*keys])


def encode(rows: DataFrame, key: str = "symbol") -> DataFrame:
    """Messages keyed by symbol, so that a broker keeps the order within a symbol."""
    return rows.select(F.col(key).cast("string").alias("key"),
                       F.to_json(F.struct(*rows.columns)).alias("value"))


def publish(rows: DataFrame, topic: dict[str, str] | None) -> None:
    """Give rows of a micro-batch out as messages. ``topic`` names the ``format`` and its options, such
    as ``{"format": "kafka", "topic": "silver", ...}`` or ``{"format": "json", "path": ...}``.

    At least once: a repeated micro-batch gives its messages again, and readers that keep the last
    message of a key and date lose nothing by that.
    """
    if topic:
        options = {name: value for name, value in topic.items() if name != "format"}
        encode(rows).write.format(topic["format"]).options(**options).mode("append").save()


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start with a checkpoint: a pass over what is there now, or a micro-batch ``every`` so often."""
    writer = writer.option("checkpointLocation", checkpoint)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
