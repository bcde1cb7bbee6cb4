"""Reading raw files: names, types, missing and bad cells, loads."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from barwright.operators.gold import gold_features
from barwright.operators.silver import build_silver
from barwright.plans import refresh
from barwright.sources import raw, tables
from bars_help import day, price, rows_of

HEADER = "date,open,high,low,close,volume,symbol\n"


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder)


def read(spark, tmp_path, text, **options):
    return raw.read_csv_bars(spark, write(tmp_path, "a.csv", text), **options)


def test_csv_columns_in_any_order_and_letter_case(spark, tmp_path):
    got = read(spark, tmp_path, "Symbol,VOLUME,extra,Close,low,HIGH,Open,DT\n"
                                "A,5,x,1.5,1,2,1.25,2024-01-02\n", seq=7)
    assert rows_of(got.bars) == [("A", day("2024-01-02"), price(1.25), price(2), price(1),
                                  price(1.5), 5, "csv", 7)]
    assert got.bad.isEmpty()


def test_missing_cells_become_null_and_missing_volume_becomes_zero(spark, tmp_path):
    got = read(spark, tmp_path, HEADER + "2024-01-02,NaN,2,1,N/A,,A\n2024-01-03,1,2,1,1,nan,B\n")
    assert rows_of(got.bars, "symbol", "open", "close", "volume") == [
        ("A", None, None, 0), ("B", price(1), price(1), 0)]
    assert got.bad.isEmpty()


def test_an_empty_symbol_is_null_but_the_ticker_na_stays(spark, tmp_path):
    text = HEADER + "2024-01-02,1,1,1,1,1,\n2024-01-02,1,1,1,1,1,NA\n"
    assert rows_of(read(spark, tmp_path, text).bars, "symbol") == [(None,), ("NA",)]
    named = read(spark, tmp_path, text, missing_symbol="nan")
    assert rows_of(named.bars, "symbol") == [("NA",), ("nan",)]


def test_bad_cells_cost_their_row_only(spark, tmp_path):
    got = read(spark, tmp_path, HEADER
               + "2024-01-02,1,1,1,1,1.5,FRACTION\n2024-01-02,x,1,1,1,1,TEXT\n"
               + "02/30/2024,1,1,1,1,1,DATE\n2024-01-02,1,1\n"
               + "2024-01-02,1,1,1,1,2.0,GOOD\n2024-01-02 09:30:00,1,1,1,1,-4,ALSO\n")
    assert rows_of(got.bars, "symbol", "dt", "volume") == [
        ("ALSO", day("2024-01-02"), -4), ("GOOD", day("2024-01-02"), 2)]
    assert sorted(r["reason"] for r in got.bad.collect()) == [
        "malformed row", "unreadable: date", "unreadable: open", "unreadable: volume"]


def test_files_of_one_folder_must_share_their_header(spark, tmp_path):
    write(tmp_path, "a.csv", HEADER + "2024-01-02,1,2,0,1,5,A\n")
    write(tmp_path, "b.csv", "date,close,high,low,open,volume,symbol\n2024-01-02,9,9,9,8,5,B\n")
    with pytest.raises(Exception, match="header does not conform"):
        raw.read_csv_bars(spark, str(tmp_path)).bars.collect()


def test_dates_in_another_format(spark, tmp_path):
    got = read(spark, tmp_path, HEADER + "01/31/2024,1,1,1,1,1,A\n31/01/2024,1,1,1,1,1,B\n",
               date_format="MM/dd/yyyy")
    assert rows_of(got.bars, "symbol", "dt") == [("A", day("2024-01-31"))]
    assert [r["reason"] for r in got.bad.collect()] == ["unreadable: date"]


def test_quoted_cells(spark, tmp_path):
    got = read(spark, tmp_path, HEADER + '"2024-01-02","1","1","1","1","1","A ""x"", B"\n')
    assert rows_of(got.bars, "symbol") == [('A "x", B',)]


def test_csv_needs_its_columns(spark, tmp_path):
    with pytest.raises(ValueError, match="date"):
        read(spark, tmp_path, "day,open,high,low,close,volume,symbol\n1,1,1,1,1,1,A\n")
    with pytest.raises(ValueError, match="volume"):
        read(spark, tmp_path, "date,open,high,low,close,symbol\n2024-01-02,1,1,1,1,A\n")
    with pytest.raises(ValueError, match="letter case"):
        raw.lower_case_names(spark.createDataFrame([], "Open int, open int"))


def feed(spark, rows, date="Date", volume=True):
    names = [date, "Open", "High", "Low", "Close", "Adj Close", *(["Volume"] if volume else [])]
    return spark.createDataFrame(rows, names)


def test_feed_of_one_symbol_with_a_half_open_date_range(spark, tmp_path):
    path = str(tmp_path / "f")
    feed(spark, [(day(f"2024-01-{d:02}"), 1.0, 2.0, 0.5, 1.5, 1.4, 10) for d in range(1, 6)]) \
        .write.parquet(path)
    got = raw.read_feed(spark, path, "AAA", start="2024-01-02", end="2024-01-04")
    assert rows_of(got.bars, "symbol", "dt", "close", "volume") == [
        ("AAA", day("2024-01-02"), price(1.5), 10), ("AAA", day("2024-01-03"), price(1.5), 10)]


def test_feed_end_defaults_to_today(spark):
    got = raw.feed_bars(feed(spark, [(day("2024-01-01"), 1.0, 1.0, 1.0, 1.0, 1.0, 1),
                                     (day("2999-01-01"), 1.0, 1.0, 1.0, 1.0, 1.0, 1)]), "A")
    assert rows_of(got.bars, "dt") == [(day("2024-01-01"),)]


def test_feed_volume_may_be_absent_or_null_and_nan_prices_are_missing(spark):
    absent = raw.feed_bars(feed(spark, [(day("2024-01-01"), 1.0, 1.0, 1.0, 1.0, 1.0)],
                                volume=False), "A")
    assert rows_of(absent.bars, "volume") == [(0,)]
    null = raw.feed_bars(feed(spark, [(day("2024-01-01"), float("nan"), 1.0, 1.0, 1.0, 1.0, None),
                                      (day("2024-01-02"), 1.0, 1.0, 1.0, 1.0, 1.0, 1.5),
                                      (day("2024-01-03"), 1.0, 1.0, 1.0, 1.0, 1.0, 3.0)]), "A")
    assert rows_of(null.bars, "open", "volume") == [(None, 0), (price(1), 3)]
    assert [r["reason"] for r in null.bad.collect()] == ["unreadable: volume"]


def test_intraday_feed_is_cut_to_dates_and_date_wins_over_datetime(spark):
    intraday = spark.sql("""SELECT TIMESTAMP_NTZ'2024-01-02 23:59:59' AS Datetime,
        1.0 AS Open, 1.0 AS High, 1.0 AS Low, 1.0 AS Close, 1 AS Volume""")
    assert rows_of(raw.feed_bars(intraday, "A").bars, "dt") == [(day("2024-01-02"),)]
    both = intraday.withColumn("Date", F.lit("2024-01-05"))
    assert rows_of(raw.feed_bars(both, "A").bars, "dt") == [(day("2024-01-05"),)]
    with pytest.raises(ValueError, match="date"):
        raw.feed_bars(intraday.drop("Datetime"), "A")


def test_json_feed(spark, tmp_path):
    path = write(tmp_path, "x.json", '{"Date":"2024-01-02","Open":"1","High":2,"Low":0.5,'
                                     '"Close":1.25,"Adj Close":9}\n')
    assert rows_of(raw.read_feed(spark, path, "A", fmt="json").bars, "close", "volume") == [
        (price(1.25), 0)]


def test_a_load_appends_counts_and_keeps_rejects(spark, tmp_path):
    root = str(tmp_path / "tables")
    source = read(spark, tmp_path, HEADER + "2024-01-02,1,1,1,1,1,A\n2024-01-02,x,1,1,1,1,B\n")
    assert refresh.load(source, root, 1) == 1
    assert refresh.load(source, root, 1) == 1
    assert tables.read_table(spark, root, "bronze_price_raw").count() == 2
    assert spark.read.parquet(f"{root}/bronze_rejects").count() == 2


def test_a_strict_load_leaves_nothing_behind(spark, tmp_path):
    root = str(tmp_path / "tables")
    source = read(spark, tmp_path, HEADER + "2024-01-02,1,1,1,1,1,A\n2024-01-02,x,1,1,1,1,B\n")
    with pytest.raises(PySparkException, match="unreadable: open"):
        refresh.load(source, root, 1, strict=True)
    assert tables.read_table(spark, root, "bronze_price_raw").count() == 0


def test_an_empty_source_is_an_error(spark, tmp_path):
    with pytest.raises(raw.EmptySourceError):
        refresh.load(read(spark, tmp_path, HEADER), str(tmp_path / "t"), 1)


def test_source_names_are_folder_names(spark, bronze, tmp_path):
    with pytest.raises(ValueError, match="folder"):
        tables.append_bronze(bronze([]), str(tmp_path), "a/b", 1)


def test_two_level_names_keep_their_first_level(spark):
    frame = spark.createDataFrame([], "`('Close', 'AAA')` double, Date date")
    assert raw.lower_case_names(frame).columns == ["close", "date"]


def test_loads_by_path(spark, tmp_path):
    root = str(tmp_path / "tables")
    (tmp_path / "csv").mkdir()
    path = write(tmp_path / "csv", "a.csv", HEADER + "2024-01-02,1,1,1,1,1,A\n")
    assert refresh.load_csv_to_bronze(spark, path, root, batch=3) == 1
    feed(spark, [(day("2024-01-03"), 1.0, 2.0, 0.5, 1.5, 1.4, 10)]) \
        .write.parquet(str(tmp_path / "f"))
    assert refresh.load_feed_to_bronze(spark, str(tmp_path / "f"), root, "B", "2024-01-01") == 1
    assert rows_of(tables.read_table(spark, root, "bronze_price_raw"), "symbol", "source", "batch",
                   "seq") == [("A", "csv", 3, 3), ("B", "feed", 4, 4)]


def test_an_intraday_extract_becomes_daily_bars_by_time(spark, tmp_path):
    rows = [("2024-01-02 15:00:00", 4.0, 9.0, 1.0, 5.0, 10), ("2024-01-02 09:30:00", 2.0, 3.0, 2.0, 3.0, 5),
            ("2024-01-02 12:00:00", 3.0, 4.0, 0.5, None, 7), ("2024-01-03 09:30:00", 1.0, 1.0, 1.0, 1.0, None)]
    spark.createDataFrame(rows, "Datetime string, Open double, High double, Low double, "
                          "Close double, Volume long").write.parquet(str(tmp_path / "feed"))
    root = str(tmp_path / "root")
    loaded = refresh.load_feed_to_bronze(spark, str(tmp_path / "feed"), root, "ABC", "2024-01-01",
                                         "2024-02-01", intraday=True)
    assert loaded == 3  # two bars, and the incomplete row as it is
    refresh.refresh_all(spark, root)
    got = tables.read_table(spark, root, "price_silver").orderBy("dt").select(
        "open", "high", "low", "close", "volume").collect()
    assert [tuple(map(float, r)) for r in got] == [(2, 9, 1, 5, 15), (1, 1, 1, 1, 0)]


def test_price_digits(spark, tmp_path):
    text = HEADER + "".join(f"2024-01-0{d},{p},{p},{p},{p},1,A\n" for d, p in enumerate(
        ["0.00000012", "123.456789012345678", "1234567890123.25", "1.2e-7", "0.0000000000001", "0"], 1))
    parsed = read(spark, tmp_path, text)
    good = {r["dt"].day: r["close"] for r in parsed.bars.collect()}
    assert good == {1: Decimal("0.00000012"), 2: Decimal("123.45678901"),
                    3: Decimal("1234567890123.25"), 4: Decimal("0.00000012"), 6: Decimal(0)}
    assert "close" in parsed.bad.first()["reason"]
    tiny = gold_features(build_silver(parsed.bars.where("dt < '2024-01-02'").unionByName(
        parsed.bars.where("dt = '2024-01-04'"))))
    assert [r["ma3"] for r in tiny.orderBy("dt").collect()] == [1.2e-7, 1.2e-7]


def test_whole_volumes(spark, tmp_path):
    text = HEADER + "".join(f"2024-01-0{d},1,1,1,1,{v},A\n" for d, v in enumerate(
        ["1500", "1500.0", "1.0000001", "1.5"], 1))
    parsed = read(spark, tmp_path, text)
    assert sorted(r["volume"] for r in parsed.bars.collect()) == [1500, 1500]
    assert parsed.bad.count() == 2
