"""Raw bars from files: column names, types, missing cells and bad cells.

Every cell is read as text and converted with ``try_cast``, so one bad cell costs its row and not
the load. A row is *bad* when a cell holds something that does not convert; a missing cell is not
bad, it becomes NULL (volume: 0), and silver decides about the row.
"""

from __future__ import annotations

import datetime
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.operators.bars import bar_aggregates
from barwright.operators.silver import is_complete, clamp_volume
from barwright.schemas import BRONZE, PRICE, PRICE_COLUMNS

CORRUPT = "_corrupt_record"

# The cell texts that mean "missing" in price, date and volume columns.
MISSING = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
           "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

# JSON lines have no header to read the names from. This is the usual vendor layout; pass another
# schema for any other, such as an intraday one with Datetime.
FEED_JSON = T.StructType([T.StructField(name, T.StringType()) for name in
                          ["Date", "Open", "High", "Low", "Close", "Volume"]])


class EmptySourceError(ValueError):
    """A source without a single row is an error, not an empty success."""


@dataclass(frozen=True)
class RawBars:
    """Parsed rows: the bronze columns, ``_raw`` (the row as JSON) and ``_reason`` (NULL if good)."""

    source: str
    parsed: DataFrame

    @property
    def bars(self) -> DataFrame:
        return self.parsed.where(F.col("_reason").isNull()).select(*BRONZE.names)

    @property
    def bad(self) -> DataFrame:
        return self.parsed.where(F.col("_reason").isNotNull()).select(
            F.col("_raw").alias("raw"), F.col("_reason").alias("reason"))

    @property
    def strict(self) -> DataFrame:
        """As ``bars``, but meeting a bad row fails the job, so that nothing is loaded."""
        message = F.concat(F.col("_reason"), F.lit(" in "), F.col("_raw"))
        stop = F.when(F.col("_reason").isNotNull(), F.raise_error(message).cast("long"))
        return self.parsed.withColumn("seq", F.coalesce(stop, F.col("seq"))).select(*BRONZE.names)


def lower_case_names(raw: DataFrame) -> DataFrame:
    """Lower-case names; of a two-level name such as ``('Close', 'AAA')`` the first level."""
    names = [re.sub(r"^\('([^']*)',.*\)$", r"\1", name).lower() for name in raw.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"columns differ only in letter case: {repeated}")
    return raw.toDF(*names)


def date_column(raw: DataFrame, accepted: list[str]) -> str:
    """The first of ``accepted`` that ``raw`` has."""
    for name in accepted:
        if name in raw.columns:
            return name
    raise ValueError(f"expected a date column named one of {accepted}, got {raw.columns}")


def _present(raw: DataFrame, name: str) -> Column:
    """The cell, NULL when it is missing; text unless the column is a number already."""
    kind = raw.schema[name].dataType
    cell = F.col(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(cell), cell)
    if isinstance(kind, T.NumericType):
        return cell
    text = F.trim(cell.cast("string"))
    return F.when(~text.isin(MISSING), text)


def _date(raw: DataFrame, name: str, present: Column, pattern: str | None) -> Column:
    if isinstance(raw.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.to_date(name)
    if pattern:
        return F.try_to_timestamp(present, F.lit(pattern)).cast("date")
    return present.try_cast("timestamp_ntz").cast("date")


def _time(raw: DataFrame, name: str, present: Column, pattern: str | None) -> Column:
    if isinstance(raw.schema[name].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return F.col(name).cast("timestamp_ntz")
    if pattern:
        return F.try_to_timestamp(present, F.lit(pattern)).cast("timestamp_ntz")
    return present.try_cast("timestamp_ntz")


def _price(present: Column) -> Column:
    """Rounded to the digits of a price; NULL for one that is not 0 and would become it."""
    price = present.try_cast(PRICE)
    return F.when((price != 0) | (present.try_cast("double") == 0), price)


def _whole_number(present: Column) -> Column:
    """1500 and '1500.0' convert, 1.5 does not."""
    number = present.try_cast("decimal(38,18)")
    return F.when(number == F.floor(number), number).try_cast("long")


def parse_bars(raw: DataFrame, dates: list[str], source: str, seq: int | Column = 0,
               symbol: str | None = None, volume_required: bool = False,
               missing_symbol: str | None = None, date_format: str | None = None,
               keep_time: bool = False) -> RawBars:
    """The canonical columns of ``raw``, whose names are in lower case.

    ``symbol`` names a source that holds one symbol and no symbol column. An empty symbol cell
    becomes ``missing_symbol``; by default that is NULL, which silver rejects. Dates as text are ISO
    dates or timestamps unless ``date_format`` says otherwise.
    """
    required = [*PRICE_COLUMNS, *([] if symbol else ["symbol"]),
                *(["volume"] if volume_required else [])]
    absent = [name for name in required if name not in raw.columns]
    if absent:
        raise ValueError(f"source lacks the columns {absent}")

    date = date_column(raw, dates)
    cells = {name: _present(raw, name)
             for name in [date, *PRICE_COLUMNS, "volume"] if name in raw.columns}
    values = {name: _price(cells[name]) for name in PRICE_COLUMNS}
    values[date] = _date(raw, date, cells[date], date_format)
    if "volume" in cells:
        values["volume"] = _whole_number(cells["volume"])

    unreadable = [F.when(cells[name].isNotNull() & values[name].isNull(), F.lit(name))
                  for name in values]
    reason = F.concat_ws(", ", *unreadable)
    reason = F.when(reason != "", F.concat(F.lit("unreadable: "), reason))
    if CORRUPT in raw.columns:
        reason = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed row")).otherwise(reason)

    if symbol:
        name = F.lit(symbol)
    else:
        text = F.trim(F.col("symbol").cast("string"))
        name = F.coalesce(F.when(text != "", text), F.lit(missing_symbol))
    columns = {
        **values,
        "symbol": name,
        "dt": values[date],
        "volume": F.coalesce(values.get("volume", F.lit(None)), F.lit(0)),
        "source": F.lit(source),
        "seq": F.lit(seq) if isinstance(seq, int) else seq,
    }
    return RawBars(source, raw.select(
        *[columns[f.name].cast(f.dataType).alias(f.name) for f in BRONZE.fields],
        F.to_json(F.struct(*raw.columns)).alias("_raw"),
        reason.alias("_reason"),
        *([_time(raw, date, cells[date], date_format).alias("_ts")] if keep_time else []),
    ))


def header_names(spark: SparkSession, path: str) -> list[str]:
    """The column names of CSV files, from the first line that is not empty.

    Spark takes them from the same line, but lists every file as a path of its own for that.
    """
    text = spark.read.text(path)
    line = text.where(F.length(F.trim("value")) > 0).select("value").first()
    if line is None:
        return spark.read.csv(path, header=True).columns
    header = spark.sparkContext.parallelize([line["value"]], 1)
    names = spark.read.csv(header, header=True).columns
    # Folders named by column and value.
    return names + [name for name in text.columns[1:] if name not in names]


def read_csv_bars(spark: SparkSession, path: str, source: str = "csv", seq: int | Column = 0,
                  missing_symbol: str | None = None, date_format: str | None = None) -> RawBars:
    """CSV with a header in any column order and letter case; ``date`` or ``dt``, all others named
    as in the tables, further columns ignored.

    Names come from the first header and no data is scanned to infer types. All files must share
    that header: ``enforceSchema`` off makes Spark compare each file's header and fail, where it
    would otherwise read columns of another order by position.
    """
    names = header_names(spark, path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*names, CORRUPT]])
    raw = spark.read.csv(
        path, schema=schema, header=True, enforceSchema=False, mode="PERMISSIVE",
        columnNameOfCorruptRecord=CORRUPT, escape='"')
    return parse_bars(lower_case_names(raw), ["dt", "date"], source, seq, volume_required=True,
                      missing_symbol=missing_symbol, date_format=date_format)


def read_feed(spark: SparkSession, path: str, symbol: str | None = None,
              start: str | None = None, end: str | None = None, fmt: str = "parquet",
              source: str = "feed", seq: int | Column = 0,
              schema: T.StructType | str | None = None,
              date_format: str | None = None, intraday: bool = False) -> RawBars:
    """Landed vendor extracts: ``Date`` or ``Datetime`` columns, volume optional.

    ``symbol`` is the one the extracts are about; leave it out when they carry a symbol column.
    Dates from ``start`` up to but not including ``end`` are kept; ``end`` defaults to today.
    ``intraday`` rolls the rows of a day up to one bar by their times, ties by ``seq``.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if fmt == "json":
        schema = schema or FEED_JSON
    raw = lower_case_names((reader.schema(schema) if schema else reader).load(path))
    return feed_bars(raw, symbol, start, end, source, seq, date_format, intraday)


def feed_bars(raw: DataFrame, symbol: str | None = None, start: str | None = None,
              end: str | None = None, source: str = "feed", seq: int | Column = 0,
              date_format: str | None = None, intraday: bool = False) -> RawBars:
    """:func:`read_feed` for extracts that are a DataFrame already, batch or stream."""
    raw = lower_case_names(raw)
    end = end or datetime.datetime.now(datetime.timezone.utc).date().isoformat()
    parsed = parse_bars(raw, ["date", "datetime"], source, seq, symbol,
                        date_format=date_format, keep_time=intraday).parsed
    outside = F.col("dt") >= F.lit(end).cast("date")
    if start:
        outside = outside | (F.col("dt") < F.lit(start).cast("date"))
    # A row without a date is kept: it is bad, or silver will reject it.
    kept = parsed.where(F.col("dt").isNull() | ~outside)
    return RawBars(source, _daily(kept) if intraday else kept)


def _daily(parsed: DataFrame) -> DataFrame:
    """Complete rows of a symbol and day as one bar, first and last by time, ties by ``seq``; its
    ``seq`` is the largest. Other rows stay as they are."""
    usable = is_complete() & F.col("_reason").isNull()
    # One number that orders by both: fixed in width, so days are aggregated by hash.
    order = (F.unix_micros(F.col("_ts").cast("timestamp")).cast("decimal(18,0)")
             * F.expr("CAST('10000000000000000000' AS decimal(20,0))") + F.col("seq")).cast("decimal(38,0)")
    bars = clamp_volume(parsed.where(usable)).withColumn("_order", order).groupBy(
        "symbol", "dt", "source").agg(
        *bar_aggregates("_order", "open", "high", "low", "close", "volume"),
        F.max("seq").alias("seq"))
    none = F.lit(None).cast("string")
    return bars.select(*BRONZE.names, none.alias("_raw"), none.alias("_reason")).unionByName(
        parsed.where(~usable).drop("_ts"))
