"""Arithmetic that gives one answer for any partitioning.

Sums run on decimals and are exact; each result then takes a single floating-point division.
``avg(decimal)`` would round to four extra digits instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def exact_mean(total: Column, count: Column) -> Column:
    return total.cast("double") / count


def simple_return(current: Column, previous: Column) -> Column:
    """``(current - previous) / previous``; NULL without a previous value or when it is zero."""
    return (current - previous).cast("double") / F.nullif(previous, F.lit(0)).cast("double")


def non_negative(amount: Column) -> Column:
    return F.greatest(F.lit(0), F.coalesce(amount, F.lit(0))).cast("long")
