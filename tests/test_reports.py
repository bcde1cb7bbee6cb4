"""Bars, calendars, quality reports, schema versions and the generator."""

from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.operators import calendar, merge, quality, serving, synth
from barwright.operators.bars import daily_bars
from barwright.operators.gold import gold_features
from barwright.operators.silver import build_silver
from barwright.schemas import BRONZE, GOLD, STORED, SchemaChangeError, check_compatible, empty_table
from barwright.sources import raw
from bars_help import bar, day, price, rows_of


def test_daily_bars_take_first_and_last_by_order(spark):
    ticks = spark.sql("""SELECT * FROM VALUES
        ('A', TIMESTAMP_NTZ'2024-01-02 10:00:00', 5.0, 10L, 2L),
        ('A', TIMESTAMP_NTZ'2024-01-02 10:00:00', 3.0, 20L, 1L),
        ('A', TIMESTAMP_NTZ'2024-01-02 23:59:59', 9.0, 5L, 3L),
        ('A', TIMESTAMP_NTZ'2024-01-03 00:00:00', 4.0, 1L, 4L) AS t(symbol, ts, price, size, seq)""")
    assert rows_of(daily_bars(ticks)) == [
        ("A", day("2024-01-02"), price(3), price(9), price(3), price(9), 35),
        ("A", day("2024-01-03"), price(4), price(4), price(4), price(4), 1)]


@pytest.mark.parametrize("start", ["2000-01-03", "2024-02-28", "2024-03-02", "2024-03-03"])
def test_business_days(spark, start):
    expected, date = [], datetime.date.fromisoformat(start)
    while len(expected) < 23:
        if date.weekday() < 5:
            expected.append((date,))
        date += datetime.timedelta(days=1)
    assert rows_of(calendar.business_days(spark, start, 23)) == expected


def test_five_thousand_days_from_2000_end_in_2019(spark):
    assert calendar.business_days(spark, "2000-01-03", 5000).agg(F.max("dt")).first()[0] \
        == day("2019-03-01")


def test_gaps_are_the_missing_business_days(bronze):
    # Friday the 5th to Wednesday the 10th: Monday and Tuesday are missing.
    rows = bronze([bar("A", "2024-01-05", 1), bar("A", "2024-01-10", 1), bar("A", "2024-01-10", 2),
                   bar("B", "2024-01-05", 1), bar("B", "2024-01-08", 1)])
    assert rows_of(calendar.completeness_gaps(rows)) == [
        ("A", day("2024-01-08")), ("A", day("2024-01-09"))]


def test_quality_report_counts_each_failure(bronze):
    rows = bronze([bar("A", "2024-01-02", 5, volume=-1, high=4), bar("A", "2024-01-02", 5),
                   bar(None, "2024-01-03", 1), bar("B", "2024-01-02", 5, low=6)])
    report = {r["check_name"]: (r["n_failed"], r["n_rows"])
              for r in quality.quality_report(rows).collect()}
    assert report["volume_is_negative"] == (1, 4)
    assert report["ohlc_is_inconsistent"] == (2, 4)
    assert report["symbol_is_null"] == (1, 4)
    assert report["key_is_repeated"] == (1, 4)
    assert sum(failed for failed, _ in report.values()) == 5
    assert rows_of(merge.duplicate_keys(rows)) == [("A", day("2024-01-02"), 2)]


def test_quality_report_of_nothing(bronze):
    assert {(r["n_failed"], r["n_rows"]) for r in quality.quality_report(bronze([])).collect()} \
        == {(0, 0)}


def test_drift_compares_both_sides_of_the_split(bronze):
    rows = bronze([bar("A", "2024-01-01", 2), bar("A", "2024-01-02", 4),
                   bar("A", "2024-01-08", 9), bar("A", "2024-01-09", None, open=1, high=1, low=1),
                   bar("B", "2024-01-01", 1)])
    report = {r["symbol"]: r for r in
              quality.drift_report(rows, quality.middle_date(rows)).collect()}
    a = report["A"]
    assert (a["n_ref"], a["mean_ref"], a["std_ref"], a["null_rate_ref"]) == (2, 3.0, 1.4142, 0.0)
    assert (a["n_cur"], a["mean_cur"], a["null_rate_cur"], a["mean_shift"]) == (2, 9.0, 0.5, 2.0)
    assert (report["B"]["n_cur"], report["B"]["mean_cur"], report["B"]["null_rate_cur"]) \
        == (0, None, None)


def test_duplicate_rate(bronze):
    rows = bronze([bar("A", "2024-01-02", 1), bar("A", "2024-01-02", 2),
                   bar("A", "2024-01-03", 2), bar("A", "2024-01-02", 1, source="u")])
    assert rows_of(quality.duplicate_rate(rows)) == [("t", 3, 2, 1.5), ("u", 1, 1, 1.0)]


def test_reconcile_layers(bronze):
    rows = bronze([bar("A", "2024-01-02", 1), bar("B", "2024-01-02", 1), bar(None, "2024-01-02", 1)])
    silver = build_silver(rows)
    assert quality.reconcile_layers(rows, silver, gold_features(silver)).isEmpty()
    partial = gold_features(silver.where("symbol = 'A'"))
    assert rows_of(quality.reconcile_layers(rows, silver, partial)) == [
        ("B", day("2024-01-02"), True, True, False)]


def test_both_ways_to_the_latest_rows_agree(bronze):
    gold = gold_features(build_silver(bronze(
        [bar(s, f"2024-01-{d:02}", d) for s, n in (("A", 3), ("B", 9)) for d in range(1, n)])))
    assert rows_of(serving.latest_features(gold), "symbol", "dt") == [
        ("A", day("2024-01-02")), ("B", day("2024-01-08"))]
    assert rows_of(serving.latest_features(gold)) == rows_of(serving.latest_ranked(gold))


def test_schemas_may_grow_but_not_change():
    wider = T.StructType([*GOLD.fields, T.StructField("ma50", T.DoubleType())])
    assert check_compatible(GOLD, wider) == ["ma50"]
    assert check_compatible(GOLD.json(), GOLD) == []
    for new in (T.StructType(GOLD.fields[1:]),
                T.StructType([T.StructField("symbol", T.LongType()), *GOLD.fields[1:]]),
                T.StructType([T.StructField("symbol", T.StringType(), False), *GOLD.fields[1:]]),
                T.StructType([*GOLD.fields, T.StructField("x", T.LongType(), False)])):
        with pytest.raises(SchemaChangeError):
            check_compatible(GOLD, new)


@pytest.mark.parametrize("name", list(STORED))
def test_an_absent_table_reads_as_empty(spark, name):
    assert empty_table(spark, name).schema == STORED[name]


def test_generator_keeps_its_promises(spark):
    bars = synth.generate_bars(spark, num_symbols=7, days=400)
    report = synth.profile(bars).collect()
    assert len(report) == 7 and {r["n_rows"] for r in report} == {400}
    assert {(r["weekend_rows"], r["ohlc_violations"], r["volume_out_of_range"])
            for r in report} == {(0, 0, 0)}
    assert {r["first_dt"] for r in report} == {day("2000-01-03")}
    assert sorted(r["symbol"] for r in report)[-1] == "SYM0007"
    moments = bars.select(
        (F.col("close") / F.lag("close").over(
            synth.Window.partitionBy("symbol").orderBy("dt")) - 1).alias("r")
    ).agg(F.avg("r"), F.stddev("r")).first()
    assert abs(moments[0]) < 0.002 and abs(moments[1] - 0.02) < 0.002


def test_generator_draws_do_not_depend_on_partitions(spark):
    symbols = synth.numbered_symbols(spark, 5)
    one, many = (rows_of(synth.synth_bars(symbols, 50, partitions=n)) for n in (1, 8))
    assert one == many
    assert rows_of(synth.synth_bars(symbols, 50, seed=43)) != one


def test_generator_rounds_the_number_of_rows_up_to_whole_symbols(spark):
    assert synth.generate_bars(spark, rows=5001).count() == 10000


def test_first_bar_opens_at_the_start_price(spark):
    first = synth.generate_bars(spark, num_symbols=3, days=2).where("dt = DATE'2000-01-03'")
    assert rows_of(first, "symbol", "open") == [
        ("SYM0001", 100), ("SYM0002", 100.5), ("SYM0003", 101)]


def test_split_csv_reads_back(spark, tmp_path):
    bars = synth.generate_bars(spark, num_symbols=2, days=30)
    path = str(tmp_path / "csv")
    synth.write_csv(bars, path, split_rows=7)
    files = list((tmp_path / "csv").glob("*.csv"))
    assert max(len(f.read_text().splitlines()) for f in files) == 8
    assert {f.read_text().splitlines()[0] for f in files} == {",".join(synth.CSV_COLUMNS)}
    got = raw.read_csv_bars(spark, path)
    assert got.bad.isEmpty()
    assert rows_of(got.bars.select(bars.columns)) == rows_of(
        bars.select("symbol", "dt", *[F.col(c).cast("decimal(28,8)").alias(c)
                                      for c in ("open", "high", "low", "close")], "volume"))


def test_header_of_split_csv_is_read_from_one_file(spark, tmp_path):
    path = str(tmp_path / "csv")
    synth.write_csv(synth.generate_bars(spark, num_symbols=2, days=60), path, split_rows=2)
    assert len(list((tmp_path / "csv").glob("*.csv"))) > 50
    spark.sparkContext.setJobGroup("header", "")
    try:
        raw.read_csv_bars(spark, path)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [s for job in status.getJobIdsForGroup("header") for s in status.getJobInfo(job).stageIds]
    assert 0 < sum(status.getStageInfo(s).numTasks for s in stages) < 10


def test_header_names_are_those_spark_finds(spark, tmp_path):
    for number, header in enumerate(['a,"b ""c"", d",,a', " \n\nx , y", "﻿date,open"]):
        path = tmp_path / str(number)
        (path / "kind=1").mkdir(parents=True)
        (path / "kind=1" / "empty.csv").write_text("")
        (path / "kind=1" / "rows.csv").write_text(header + "\n1,2,3,4\n")
        assert raw.header_names(spark, str(path)) == spark.read.csv(str(path), header=True).columns


def test_a_split_that_fails_leaves_no_files(spark, tmp_path):
    bars, path = synth.generate_bars(spark, num_symbols=2, days=30), str(tmp_path / "csv")
    stop = F.when(F.col("symbol") == "SYM0002", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        synth.write_csv(bars.withColumn("symbol", F.coalesce(stop, "symbol")), path, split_rows=7)
    assert not (tmp_path / "csv").exists()
    synth.write_csv(bars, path, split_rows=7)
    files = sorted((tmp_path / "csv").glob("*.csv"))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        synth.write_csv(bars, path, split_rows=7)
    assert files and sorted((tmp_path / "csv").glob("*.csv")) == files
