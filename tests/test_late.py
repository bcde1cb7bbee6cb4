"""Bars, late rows and open days add up, whatever the order of files and the failures between."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from barwright.operators.bars import daily_bars
from barwright.streaming import late
from barwright.streaming.topics import read_stream
from bars_help import rows_of

DELAY = datetime.timedelta(days=1)


def at(day, hour=12):
    return datetime.datetime(2024, 1, day, hour)


# Micro-batches: the second has rows of a day that is over, the third ends more days.
BATCHES = [[("A", at(1), 10, 1, 1), ("A", at(1, 13), 11, 2, 2), ("B", at(4), 5, 1, 3)],
           [("A", at(1, 14), 99, 7, 4), ("A", at(3), 12, 1, 5), ("B", at(4, 13), 6, 1, 6)],
           [("B", at(9), 7, 1, 7), ("A", at(2), 98, 1, 8), ("A", at(8), 13, 1, 9)]]


def frames(spark):
    return [spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, price int, size long, seq long")
            .withColumn("price", F.col("price").cast("decimal(28,8)")) for rows in BATCHES]


def tables(spark, root):
    schema = frames(spark)[0].schema
    return (rows_of(late.read_stream_bars(spark, root)), *(
        sorted(r["seq"] for r in late.read_rows(spark, root, name, schema).collect())
        for name in ("late_rows", "open_rows")))


def wanted(spark):
    rows = frames(spark)
    counted = rows[0].unionByName(rows[1]).unionByName(rows[2]).where("seq NOT IN (4, 8)")
    return rows_of(daily_bars(counted.where("ts < TIMESTAMP_NTZ'2024-01-08'"))), [4, 8], [7, 9]


def test_late_rows_are_kept(spark, tmp_path):
    root = str(tmp_path)
    for batch, rows in enumerate(frames(spark)):
        late.late_batch(rows, batch, root, 86_400_000_000)
    assert tables(spark, root) == wanted(spark)


@pytest.mark.parametrize("lost", [0, 1, 2, 3])
def test_a_batch_that_fails_anywhere_may_run_again(spark, tmp_path, monkeypatch, lost):
    root = str(tmp_path)
    for batch, rows in enumerate(frames(spark)):
        calls = []

        def stop(f):
            def call(*args):
                calls.append(f)
                if len(calls) == lost + 1:
                    raise KeyboardInterrupt
                return f(*args)
            return call

        with monkeypatch.context() as patch:
            for name in ("change_state", "remove"):
                patch.setattr(late, name, stop(getattr(late, name)))
            try:
                late.late_batch(rows, batch, root, 86_400_000_000)
            except KeyboardInterrupt:
                pass
        late.late_batch(rows, batch, root, 86_400_000_000)
    assert tables(spark, root) == wanted(spark)


def test_a_stream_of_files_adds_up(spark, tmp_path):
    for rows in frames(spark):
        rows.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = read_stream(spark, str(tmp_path / "in"), frames(spark)[0].schema, maxFilesPerTrigger="1")
    late.stream_bars_and_late_rows(stream, str(tmp_path / "t"), str(tmp_path / "c"), DELAY).awaitTermination()
    assert tables(spark, str(tmp_path / "t")) == wanted(spark)
