"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_key(dt: Column) -> Column:
    """2024-03-15 -> 202403, the folder key of silver and gold."""
    return (F.year(dt) * 100 + F.month(dt)).cast("int")


def is_business_day(dt: Column) -> Column:
    """Monday to Friday; holidays count as business days."""
    return F.weekday(dt) < 5


def utc_instant(clock: Column) -> Column:
    """The instant at which a clock in UTC shows the zone-free timestamp ``clock``.

    A cast would read it in the session's time zone.
    """
    seconds = F.hour(clock) * 3600 + F.minute(clock) * 60 + F.extract(F.lit("SECOND"), clock)
    micros = F.unix_date(F.to_date(clock)).cast("long") * 86_400_000_000 \
        + (seconds * 1_000_000).cast("long")
    return F.timestamp_micros(micros)


def utc_date(instant: Column) -> Column:
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))
