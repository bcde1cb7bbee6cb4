"""Checks on bars: constraints, sanity, completeness of keys, drift, duplicates, reconciliation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barwright.operators.merge import duplicate_keys
from barwright.operators.silver import complete_rows
from barwright.schemas import BAR_COLUMNS, KEY


class QualityError(ValueError):
    """Rows violate a constraint of their table."""


def _ohlc_broken() -> Column:
    return (F.col("low") > F.least("open", "close")) | (F.col("high") < F.greatest("open", "close"))


def ohlc_violations(bars: DataFrame) -> DataFrame:
    """Rows whose low or high does not enclose open and close."""
    return bars.where(_ohlc_broken())


def row_checks() -> dict[str, Column]:
    """Check name -> a condition that is true on a bad row."""
    checks = {f"{name}_is_null": F.col(name).isNull() for name in BAR_COLUMNS}
    checks["volume_is_negative"] = F.col("volume") < 0
    checks["ohlc_is_inconsistent"] = _ohlc_broken()
    return checks


def check_counts() -> list[Column]:
    """Aggregates that count the rows and the failures of each check, all in one pass."""
    failures = [F.count_if(bad).alias(name) for name, bad in row_checks().items()]
    return [F.count(F.lit(1)).alias("rows"), *failures]


def quality_report(bars: DataFrame) -> DataFrame:
    """One row per check: how many rows failed, of how many; and the surplus rows per key."""
    names = list(row_checks())
    # One scan: counted by key first, then added up.
    per_key = bars.groupBy(*KEY).agg(*check_counts()).withColumn(
        "key_is_repeated", F.col("rows") - 1)
    totals = per_key.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name)
                           for name in ["rows", *names, "key_is_repeated"]])
    lines = ", ".join(f"'{name}', {name}" for name in [*names, "key_is_repeated"])
    return totals.selectExpr(
        f"stack({len(names) + 1}, {lines}) AS (check_name, n_failed)", "rows AS n_rows")


def require_constraints(silver: DataFrame) -> None:
    """Raise unless every silver constraint holds: NOT NULL, volume >= 0, unique key."""
    counts = silver.agg(*check_counts()).first().asDict()
    broken = {name: n for name, n in counts.items()
              if n and name not in ("rows", "ohlc_is_inconsistent")}
    if broken:
        raise QualityError(f"rows violate constraints: {broken}")
    if not duplicate_keys(silver).isEmpty():
        raise QualityError(f"rows repeat a key {KEY}")


def enforce_constraints(rows: DataFrame, required: list[str] = BAR_COLUMNS) -> DataFrame:
    """The same rows, but evaluating one that breaks NOT NULL or volume >= 0 fails the job.

    Put in front of a write it acts as a table constraint without a pass of its own: the tasks
    fail, the write is never committed and the table stays as it was.
    """
    broken = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in required])
    if "volume" in rows.columns:
        broken = broken | (F.col("volume") < 0)
    message = F.concat(F.lit("constraint broken at "), F.to_json(F.struct(*rows.columns)))
    stop = F.raise_error(message).cast("string")
    return rows.withColumn("symbol", F.when(broken, stop).otherwise(F.col("symbol")))


def duplicate_rate(bronze: DataFrame) -> DataFrame:
    """Per source: rows, distinct keys, and rows per key."""
    per_key = bronze.groupBy("source", *KEY).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.groupBy("source").agg(
        F.sum("copies").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        (F.sum("copies").cast("double") / F.count(F.lit(1))).alias("rows_per_key"),
    )


def drift_report(bars: DataFrame, split: Column) -> DataFrame:
    """Per symbol, the close prices before ``split`` (ref) against those from it on (cur).

    Means and deviations come from exact sums of values and squares, so they do not depend on the
    order of rows; ``mean_shift`` is the relative change of the mean.
    """
    after = F.col("dt") >= split
    sides = {"ref": ~after, "cur": after}
    parts = []
    for side, here in sides.items():
        close = F.when(here, F.col("close"))
        parts += [
            F.count_if(here).alias(f"n_{side}"),
            (F.sum(close).cast("double") / F.nullif(F.count(close), F.lit(0)))
            .alias(f"mean_{side}"),
            _deviation(close).alias(f"std_{side}"),
            (F.count_if(here & F.col("close").isNull()).cast("double")
             / F.nullif(F.count_if(here), F.lit(0))).alias(f"null_rate_{side}"),
        ]
    shift = (F.col("mean_cur") - F.col("mean_ref")) / F.nullif(F.col("mean_ref"), F.lit(0.0))
    return bars.groupBy("symbol").agg(*parts).withColumn("mean_shift", shift)


def _deviation(value: Column) -> Column:
    """Sample deviation of prices, to four digits; NULL below two values. It comes from exact sums of
    six digits after the point, unless a price or a sum is too large for them."""
    exact = value.try_cast("decimal(18,6)")
    n, total = F.count(exact), F.try_sum(exact)
    squares = F.try_sum((exact * exact).try_cast("decimal(38,12)"))
    mean = total.cast("double") / F.nullif(n, F.lit(0))
    spread = (squares.cast("double") - mean * total.cast("double")) / F.nullif(n - 1, F.lit(0))
    fits = F.when(n == F.count(value), F.sqrt(F.greatest(spread, F.lit(0.0))))
    return F.when(F.count(value) > 1, F.round(F.coalesce(
        F.when(spread.isNotNull(), fits), F.stddev_samp(value.cast("double"))), 4))


def middle_date(rows: DataFrame) -> Column:
    """The date halfway between the first and the last ``dt``, as a scalar subquery."""
    first, last = F.min("dt"), F.max("dt")
    return rows.agg(F.date_add(first, F.floor(F.datediff(last, first) / 2).cast("int"))
                    .alias("middle")).scalar()


def reconcile_layers(bronze: DataFrame, silver: DataFrame, gold: DataFrame) -> DataFrame:
    """Keys that are not in all three layers, with a flag per layer.

    Bronze counts with its complete rows only; what silver drops by rule is no mismatch. A union
    and one aggregation take the place of two outer joins.
    """
    layers = {"bronze": complete_rows(bronze), "silver": silver, "gold": gold}
    tagged = [rows.select(*KEY, *[F.lit(name == layer).alias(f"in_{layer}") for layer in layers])
              for name, rows in layers.items()]
    flags = [F.bool_or(f"in_{layer}").alias(f"in_{layer}") for layer in layers]
    everywhere = reduce(lambda a, b: a & b, [F.col(f"in_{layer}") for layer in layers])
    return reduce(DataFrame.unionByName, tagged).groupBy(*KEY).agg(*flags).where(~everywhere)


def compare_tables(left: DataFrame, right: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """A row per key with its status: ``same``, ``changed``, ``only_left`` or ``only_right``.

    NULL equals NULL. Both sides must have unique keys.
    """
    values = [name for name in left.columns if name not in keys]
    a = left.select(*keys, F.struct(*values).alias("_left"))
    b = right.select(*keys, F.struct(*values).alias("_right"))
    status = (F.when(F.col("_right").isNull(), "only_left")
              .when(F.col("_left").isNull(), "only_right")
              .when(F.col("_left").eqNullSafe(F.col("_right")), "same")
              .otherwise("changed"))
    return a.join(b, keys, "full_outer").select(*keys, status.alias("status"))


def reconcile_tables(left: DataFrame, right: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """The keys whose rows differ."""
    return compare_tables(left, right, keys).where(F.col("status") != "same")


def reconcile_summary(left: DataFrame, right: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """How many keys have each status."""
    return compare_tables(left, right, keys).groupBy("status") \
        .agg(F.count(F.lit(1)).alias("n_keys"))
