"""Keyed merge: new keys are inserted, known keys overwritten, no row is deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.operators.silver import latest_per_key
from barwright.schemas import KEY


class DuplicateKeyError(ValueError):
    """An increment holds two rows for one key, so the result of a merge would be undefined."""


def duplicate_keys(rows: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Keys with more than one row, and how many."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def require_unique(rows: DataFrame, keys: list[str] = KEY) -> None:
    offender = duplicate_keys(rows, keys).first()
    if offender is not None:
        raise DuplicateKeyError(f"key occurs {offender['n_rows']} times: "
                                f"{[offender[key] for key in keys]}")


def merge_keyed(base: DataFrame, increment: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """``increment`` wins on every key it holds; its NULLs overwrite too.

    The increment is read twice and must have unique keys. AQE broadcasts its keys when they turn out
    to be small; by then ``base`` has been shuffled too.
    """
    kept = base.join(increment.select(*keys), keys, "left_anti").select(*base.columns)
    return kept.unionByName(increment)


def merge_latest(base: DataFrame, increment: DataFrame) -> DataFrame:
    """Merge of silver rows in which the higher ``seq`` wins, so that a late load of old rows does
    not replace newer ones; at equal ``seq`` the increment wins. Repeating a merge changes nothing."""
    both = base.withColumn("_new", F.lit(0)).unionByName(increment.withColumn("_new", F.lit(1)))
    return latest_per_key(both, after="_new").drop("_new")
