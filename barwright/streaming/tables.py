"""Raw rows to silver to gold, micro-batch by micro-batch.

Every step can be repeated: a micro-batch that runs again after a failure overwrites the folder of
its own number in bronze and merges rows that are there already (silver, gold). That and the
checkpoint make the tables exactly-once. In the change log each attempt has a folder of its own, so
that files which the gold stream has planned never go; keys that stand there twice are recomputed
once. The gold stream follows a list beside the log, with one small file for each attempt, written after
the attempt's rows: its micro-batches are as many as those of silver, in however many files they lie. A source name belongs to one checkpoint, since micro-batches are numbered from 0 in each.

Folders of micro-batches add up: ``compact_bronze`` gathers those of bronze, and the option
``cleanSource="delete"`` of :func:`stream_gold` removes what it has worked in from the change log.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barwright.operators.silver import build_silver
from barwright.plans.refresh import apply_to_gold, apply_to_silver, new_symbols
from barwright.schemas import BRONZE, KEY, SILVER, few_rows
from barwright.session import path_exists, remove, staged
from barwright.sources.tables import (
    load_number, load_path, note_loads, read_bronze_loads, replace_bronze_batch, table_path,
    touched_parts,
)
from barwright.streaming.topics import publish, read_stream, start

LOGGED = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("batch", T.LongType()),
    T.StructField("attempt", T.StringType()),
])


def silver_batch(rows: DataFrame, batch: int, root: str, source: str,
                 with_gold: bool = False, topic: dict[str, str] | None = None,
                 gold_topic: dict[str, str] | None = None) -> None:
    """Land one micro-batch in bronze, log its clean rows as changes, merge them into silver."""
    spark = rows.sparkSession
    number = load_number(spark, root, source, batch)
    note_loads(spark, root, [(number, source, batch)], "started")
    numbered = rows.withColumn("seq", F.coalesce("seq", F.lit(number).cast("long")))
    replace_bronze_batch(numbered.select(*BRONZE.names), root, source, batch)
    note_loads(spark, root, [(number, source, batch)], "loaded")
    attempt = uuid.uuid4().hex
    log = attempt_path(root, source, batch, attempt)
    build_silver(read_bronze_loads(spark, root, [(source, batch)])).write.parquet(log)
    changes = spark.read.schema(SILVER).parquet(log)
    parts = touched_parts(changes, root)
    with new_symbols(changes, root, parts) if with_gold else contextlib.nullcontext() as first:
        apply_to_silver(changes, root, parts, unique=True)
        publish(changes, topic)
        if with_gold:
            apply_to_gold(changes, root, lambda gold: publish(gold, gold_topic), parts, first)
    few_rows(spark, [(source, batch, attempt)], LOGGED).write.mode("append").parquet(
        table_path(root, "silver_change_list"))
    note_loads(spark, root, [(number, source, batch)], "applied")


def attempt_path(root: str, source: str, batch: int, attempt: str) -> str:
    return f"{load_path(root, 'silver_changes', source, batch)}/attempt={attempt}"


def stream_silver(raw: DataFrame, root: str, source: str, checkpoint: str,
                  every: str | None = None, with_gold: bool = False,
                  topic: dict[str, str] | None = None,
                  gold_topic: dict[str, str] | None = None) -> StreamingQuery:
    """Keep silver up to date with a stream of rows in bronze columns.

    Late rows count whenever they come: the merge is by key and ``seq``, not by a watermark. A row
    without ``seq`` gets the number of its load, which grows over all sources. ``with_gold`` does
    gold in the same micro-batch; :func:`stream_gold` does it in a query of its own. ``topic`` and
    ``gold_topic`` give the clean rows, and the features recomputed with them, out as messages.
    """
    writer = raw.writeStream.foreachBatch(
        lambda rows, batch: silver_batch(rows, batch, root, source, with_gold, topic, gold_topic))
    return start(writer, checkpoint, every)


def gold_batch(changes: DataFrame, batch: int, root: str,
               topic: dict[str, str] | None = None) -> None:
    with staged(changes.select(*KEY).distinct(), "gold-keys") as keys:
        apply_to_gold(keys, root, lambda gold: publish(gold, topic))


def logged_batch(listed: DataFrame, batch: int, root: str, topic: dict[str, str] | None = None,
                 clean: bool = False) -> None:
    """:func:`gold_batch` on the attempts that ``listed`` names. ``clean`` removes their rows when they are
    worked in, so that of a repeated micro-batch those that are gone need nothing more."""
    spark = listed.sparkSession
    paths = sorted({attempt_path(root, *row) for row in listed.select(*LOGGED.names).collect()})
    if clean:
        paths = [path for path in paths if path_exists(spark, path)]
    if paths:
        gold_batch(spark.read.schema(SILVER).parquet(*paths), batch, root, topic)
    for path in paths if clean else []:
        remove(spark, path)


def stream_gold(spark: SparkSession, root: str, checkpoint: str, every: str | None = None,
                topic: dict[str, str] | None = None, **options: str) -> StreamingQuery:
    """Follow the change log of silver and recompute the features around each change.

    Row windows are not allowed on a stream, and a late row changes features of later rows that
    were given out before, so gold is merged from a batch computation on the affected rows. If silver
    replaces a month while it is read here, the micro-batch fails and is repeated on restart; let the
    two queries take turns, or use ``with_gold``, to avoid that. ``topic`` gives the recomputed
    features out as messages; ``options`` are those of the file source, to which a micro-batch of silver
    is one file.
    """
    listed = read_stream(spark, table_path(root, "silver_change_list"), LOGGED, **options)
    clean = options.get("cleanSource", "off").lower() == "delete"
    writer = listed.writeStream.foreachBatch(
        lambda rows, batch: logged_batch(rows, batch, root, topic, clean))
    return start(writer, checkpoint, every)
