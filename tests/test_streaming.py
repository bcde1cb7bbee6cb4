"""Streams in several micro-batches, against the batch results."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from barwright.functions.dates import utc_date, utc_instant
from barwright.operators.bars import daily_bars
from barwright.operators.gold import gold_features
from barwright.operators.silver import build_silver
from barwright.plans import registry
from barwright.plans.driver_tables import feed_bronze
from barwright.plans.refresh import refresh_all
from barwright.schemas import BAR_COLUMNS, BRONZE, GOLD, SILVER
from barwright.sources import tables
from barwright.streaming.bars import streaming_daily_bars, write_daily_bars
from barwright.streaming.tables import (
    gold_batch, logged_batch, silver_batch, stream_gold, stream_silver,
)
from barwright.streaming.topics import decode, encode, read_stream
from bars_help import rows_of
from test_silver_gold import random_series

TICK = "symbol string, ts timestamp_ntz, price decimal(28,8), size bigint, seq bigint"


def shuffled_rows(seed):
    """Bars with corrections, in an order that has nothing to do with their dates."""
    rng = random.Random(seed)
    rows = random_series(rng, "A", 80, 200) + random_series(rng, "B", 30, 2000)
    rows += [(*row[:8], 2) for row in rng.sample(rows, 20)]
    rng.shuffle(rows)
    return rows


def land(bronze, rows, folder, files):
    """Three or more files of a stream, one micro-batch each."""
    for part in range(files):
        bronze(rows[part::files]).coalesce(1).write.mode("append").parquet(folder)


def test_streamed_silver_and_gold_equal_the_batch(spark, bronze, tmp_path):
    rows = shuffled_rows(4)
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    land(bronze, rows, landing, 3)
    raw = read_stream(spark, landing, BRONZE, maxFilesPerTrigger="1")
    query = stream_silver(raw, root, "live", f"{root}/cp-silver")
    query.awaitTermination()
    assert spark.read.parquet(f"{root}/bronze_price_raw").select("batch").distinct().count() == 3
    stream_gold(spark, root, f"{root}/cp-gold", maxFilesPerTrigger="1").awaitTermination()

    silver = build_silver(bronze(rows))
    stored = tables.read_table(spark, root, "price_silver").select(*SILVER.names)
    assert rows_of(stored) == rows_of(silver.select(*SILVER.names))
    gold = tables.read_table(spark, root, "features_gold").select(*GOLD.names)
    assert rows_of(gold) == rows_of(gold_features(silver))

    # A restart finds nothing new and changes nothing.
    stream_silver(raw, root, "live", f"{root}/cp-silver").awaitTermination()
    assert rows_of(tables.read_table(spark, root, "price_silver").select(*SILVER.names)) \
        == rows_of(stored)


def test_silver_and_gold_in_one_stream(spark, bronze, tmp_path):
    rows = shuffled_rows(10)
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    land(bronze, rows, landing, 2)
    raw = read_stream(spark, landing, BRONZE, maxFilesPerTrigger="1")
    stream_silver(raw, root, "live", f"{root}/cp", with_gold=True).awaitTermination()
    gold = tables.read_table(spark, root, "features_gold").select(*GOLD.names)
    assert rows_of(gold) == rows_of(gold_features(build_silver(bronze(rows))))


def test_a_repeated_micro_batch_changes_nothing(spark, bronze, tmp_path):
    root = str(tmp_path)
    rows = shuffled_rows(5)
    for part in (0, 1):
        silver_batch(bronze(rows[part::2]), part, root, "live")
    silver_batch(bronze(rows[0::2]), 0, root, "live")
    changes = tables.read_table(spark, root, "price_silver")
    for _ in range(2):
        gold_batch(changes, 0, root)
    assert tables.read_table(spark, root, "bronze_price_raw").count() == len(rows)
    assert spark.read.parquet(f"{root}/silver_changes").where("batch = 0").count() > 0
    silver = build_silver(bronze(rows))
    assert rows_of(tables.read_table(spark, root, "price_silver").select(*SILVER.names)) \
        == rows_of(silver.select(*SILVER.names))
    assert rows_of(tables.read_table(spark, root, "features_gold").select(*GOLD.names)) \
        == rows_of(gold_features(silver))


def test_a_repeated_attempt_leaves_the_logged_files(spark, bronze, tmp_path):
    root, rows = str(tmp_path), random_series(random.Random(8), "A", 30)
    silver_batch(bronze(rows), 0, root, "live")
    planned = set(spark.read.parquet(f"{root}/silver_changes").inputFiles())
    silver_batch(bronze(rows), 0, root, "live")
    assert planned < set(spark.read.parquet(f"{root}/silver_changes").inputFiles())
    stream_gold(spark, root, f"{root}/cp-gold").awaitTermination()
    gold = tables.read_table(spark, root, "features_gold").select(*GOLD.names)
    assert rows_of(gold) == rows_of(gold_features(build_silver(bronze(rows))))


def test_old_changes_are_cleaned_and_old_micro_batches_gathered(spark, bronze, tmp_path):
    root, rows = str(tmp_path), shuffled_rows(9)
    for part in range(4):
        silver_batch(bronze(rows[part::4]), part, root, "live")
        stream_gold(spark, root, f"{root}/cp-gold", cleanSource="delete").awaitTermination()
    silver = build_silver(bronze(rows))

    def check():
        stored = tables.read_table(spark, root, "bronze_price_raw").select(*BRONZE.names)
        assert rows_of(stored) == rows_of(bronze(rows).withColumn("source", F.lit("live")))
        gold = tables.read_table(spark, root, "features_gold").select(*GOLD.names)
        assert rows_of(gold) == rows_of(gold_features(silver))

    check()
    assert len(list((tmp_path / "silver_changes").rglob("*.parquet"))) < 4
    assert tables.compact_bronze(spark, root, "live") == 3
    folders = {f.name for f in (tmp_path / "bronze_price_raw" / "source=live").iterdir()}
    assert folders == {"batch=-1", "batch=3"}
    assert tables.compact_bronze(spark, root, "live") == 0
    # A restarted stream may write the newest again, and a full refresh reads both folders.
    silver_batch(bronze(rows[3::4]), 3, root, "live")
    refresh_all(spark, root)
    check()


def test_clean_rows_and_features_are_given_out_as_messages(spark, bronze, tmp_path):
    root, rows = str(tmp_path), random_series(random.Random(11), "A", 25)
    topics = [{"format": "json", "path": f"{root}/topics/{name}"} for name in ("silver", "gold")]
    silver_batch(bronze(rows), 0, root, "live", True, *topics)
    gold_batch(bronze(rows), 0, root, {"format": "json", "path": f"{root}/topics/again"})
    silver = build_silver(bronze(rows))
    for name, schema, want in (("silver", SILVER, silver), ("gold", GOLD, gold_features(silver)),
                               ("again", GOLD, gold_features(silver))):
        messages = spark.read.schema("key string, value string").json(f"{root}/topics/{name}")
        assert {row["key"] for row in messages.collect()} == {"A"}
        assert rows_of(decode(messages, schema)) == rows_of(want.select(*schema.names))


def test_rows_without_seq_are_ordered_by_micro_batch(spark, bronze, tmp_path):
    root = str(tmp_path)
    first = bronze(random_series(random.Random(6), "A", 1)).withColumn("seq", F.lit(None).cast("long"))
    dearer = first.withColumn("close", F.lit(0).cast(first.schema["close"].dataType))
    silver_batch(first, 0, root, "live")
    silver_batch(dearer, 1, root, "live")
    assert [row["close"] for row in tables.read_table(spark, root, "price_silver").collect()] == [0]


def ticks(spark, days):
    lines = [f"('S{s}', TIMESTAMP_NTZ'2024-01-{d:02} 0{h}:30:00', {d + h / 10 + s}, {h}, "
             f"{d * 100 + h * 10 + s})" for d in days for h in range(5) for s in range(2)]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(lines)} AS t(symbol, ts, price, size, seq)") \
        .select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in TICK.split(", ")])


def test_streamed_bars_of_closed_days_equal_the_batch(spark, tmp_path):
    landing = str(tmp_path / "landing")
    for days in ([1, 2], [3, 4, 5], [7, 8]):
        ticks(spark, days).coalesce(1).write.mode("append").parquet(landing)
    stream = read_stream(spark, landing, spark.read.parquet(landing).schema,
                         maxFilesPerTrigger="1")
    write_daily_bars(stream, str(tmp_path / "cp"), path=str(tmp_path / "bars")).awaitTermination()
    closed = daily_bars(spark.read.parquet(landing)).where("dt < DATE'2024-01-06'")
    got = spark.read.parquet(str(tmp_path / "bars")).select(*BAR_COLUMNS)
    assert rows_of(got) == rows_of(closed) and got.count() == 10


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo", "UTC"])
def test_utc_reading_of_zone_free_times_ignores_the_session_zone(spark, zone):
    times = ["2024-03-10 02:30:00.123456", "2024-11-03 01:30:00", "1969-12-31 23:59:59.5"]
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(t,) for t in times], "t string") \
            .select(F.col("t").cast("timestamp_ntz").alias("t"))
        got = frame.select(F.unix_micros(utc_instant(F.col("t"))),
                           utc_date(utc_instant(F.col("t"))).cast("string")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert [row[0] for row in got] == [1710037800123456, 1730597400000000, -500000]
    assert [row[1] for row in got] == [t[:10] for t in times]


def test_streaming_plan_needs_a_watermark_column(spark, tmp_path):
    ticks(spark, [1]).write.parquet(str(tmp_path / "t"))
    stream = read_stream(spark, str(tmp_path / "t"), spark.read.parquet(str(tmp_path / "t")).schema)
    assert streaming_daily_bars(stream).isStreaming


def test_messages_round_trip(spark, bronze):
    rows = bronze(random_series(random.Random(7), "A", 5))
    messages = encode(rows)
    assert messages.columns == ["key", "value"]
    kafka_like = messages.select(F.col("value").cast("binary"))
    assert rows_of(decode(kafka_like, BRONZE)) == rows_of(rows)


def test_gold_has_as_many_micro_batches_as_silver(spark, bronze, tmp_path):
    root, rows = str(tmp_path), shuffled_rows(12)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for part in range(2):
            silver_batch(bronze(rows[part::2]), part, root, "live")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(list((tmp_path / "silver_changes").rglob("*.parquet"))) > 4
    stream_gold(spark, root, f"{root}/cp-gold", maxFilesPerTrigger="1").awaitTermination()
    assert {f.name for f in (tmp_path / "cp-gold" / "commits").glob("[0-9]*")} == {"0", "1"}
    gold = tables.read_table(spark, root, "features_gold").select(*GOLD.names)
    assert rows_of(gold) == rows_of(gold_features(build_silver(bronze(rows))))


def test_a_repeated_gold_batch_whose_rows_were_cleaned_changes_nothing(spark, bronze, tmp_path):
    root, rows = str(tmp_path), shuffled_rows(13)
    silver_batch(bronze(rows), 0, root, "live")
    listed = spark.read.parquet(f"{root}/silver_change_list")
    for _ in range(2):
        logged_batch(listed, 0, root, clean=True)
    assert not list((tmp_path / "silver_changes").rglob("*.parquet"))
    gold = tables.read_table(spark, root, "features_gold").select(*GOLD.names)
    assert rows_of(gold) == rows_of(gold_features(build_silver(bronze(rows))))


def test_topic_gold_has_three_micro_batches_whatever_the_number_of_files(spark, tmp_path, monkeypatch):
    events = spark.range(4000).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01' + make_dt_interval(id % 9) AS ts", "id % 7 AS user_id",
        "CAST(id % 50 + 1 AS double) AS value")
    events.repartition(9).write.parquet(f"{tmp_path}/events.parquet")
    roots, run = [], registry.stream_tables.stream_silver
    monkeypatch.setattr(registry.stream_tables, "stream_silver",
                        lambda rows, root, *rest, **options: roots.append(root) or run(rows, root, *rest, **options))
    got = registry.QUERIES["topic_gold"](spark, str(tmp_path))
    assert rows_of(got) == rows_of(gold_features(build_silver(feed_bronze(spark, str(tmp_path)))))
    assert spark.read.parquet(f"{roots[0]}/bronze_price_raw").select("batch").distinct().count() == 3
