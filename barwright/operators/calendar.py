"""Business-day calendars and the gaps in a series."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright.functions.dates import is_business_day


def first_business_day(start: str | datetime.date) -> datetime.date:
    """``start`` itself, or the Monday after it on a weekend."""
    day = start if isinstance(start, datetime.date) else datetime.date.fromisoformat(start)
    return day + datetime.timedelta(days=7 - day.weekday() if day.weekday() >= 5 else 0)


def business_day_number(first: datetime.date, number: Column) -> Column:
    """The business day ``number`` steps after the business day ``first``."""
    monday = first - datetime.timedelta(days=first.weekday())
    step = number + first.weekday()
    return F.date_add(F.lit(monday), (F.floor(step / 5) * 7 + step % 5).cast("int"))


def business_days(spark: SparkSession, start: str | datetime.date, periods: int) -> DataFrame:
    """The first ``periods`` business days from ``start``."""
    first = first_business_day(start)
    return spark.range(periods).select(business_day_number(first, F.col("id")).alias("dt"))


def business_calendar(rows: DataFrame) -> DataFrame:
    """Every business day from the first to the last ``dt`` of ``rows``."""
    span = rows.agg(F.min("dt").alias("first"), F.max("dt").alias("last"))
    return span.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("dt")) \
        .where(is_business_day(F.col("dt")))


def completeness_gaps(silver: DataFrame) -> DataFrame:
    """Business days without a row between a symbol's first and last date.

    Looks at neighbouring dates and lists only what lies between them, so the work follows the rows
    there are and the days that are missing; no full calendar per symbol is built or joined.
    """
    # A repeated date has a distance of 0 and falls out by itself.
    days = silver.select("symbol", "dt")
    previous = F.lag("dt").over(Window.partitionBy("symbol").orderBy("dt"))
    return (days
            .withColumn("_previous", previous)
            .where(F.datediff("dt", "_previous") > 1)
            .select("symbol", F.explode(F.sequence(
                F.date_add("_previous", 1), F.date_sub("dt", 1), F.expr("INTERVAL 1 DAY"))).alias("dt"))
            .where(is_business_day(F.col("dt"))))
