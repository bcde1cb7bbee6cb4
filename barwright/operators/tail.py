"""The last rows of each symbol, enough to compute features of new days without older rows.

A tail holds the last ``TAIL`` silver rows of a symbol, or all it has if they are fewer. A frame reads
``HALO`` rows back, so every row of a full tail but the oldest ``HALO`` finds its whole frame there:
new days and corrections of the last ones need nothing else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.operators.gold import HALO, gold_features
from barwright.operators.merge import merge_latest
from barwright.schemas import GOLD, KEY

TAIL = 2 * HALO


def last_rows(silver: DataFrame, rows: int = TAIL) -> DataFrame:
    """The newest rows of each symbol; each map task passes on so many of a symbol at most."""
    newest = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("dt")))
    return silver.withColumn("_rank", newest).where(F.col("_rank") <= rows).drop("_rank")


def advance_tail(tail: DataFrame, changes: DataFrame, unique: bool = False) -> DataFrame:
    """The tail after a merge of ``changes`` into silver, by the rule of that merge. A changed row older
    than a full tail falls out again. With ``unique`` no key is repeated in ``changes``, so that the last
    of them alone can stay and the merge need not shuffle the others."""
    return last_rows(merge_latest(tail, last_rows(changes) if unique else changes))


def within_tail(tail: DataFrame, changes: DataFrame) -> DataFrame:
    """The changed rows that a tail has to take up: all but those older than a full one."""
    ends = tail.groupBy("symbol").agg(F.count(F.lit(1)).alias("_rows"), F.min("dt").alias("_oldest"))
    return changes.join(ends, "symbol", "left").where(
        F.col("_rows").isNull() | (F.col("_rows") < TAIL) | (F.col("dt") >= F.col("_oldest")))


def reach_of_tail(tail: DataFrame, changes: DataFrame) -> DataFrame:
    """The changed symbols, and whether the first changed day of each is too ``far`` back for its frame to
    be wholly in the tail."""
    place = F.row_number().over(Window.partitionBy("symbol").orderBy("dt"))
    reach = tail.withColumn("_place", place).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("_rows"), F.max(F.when(F.col("_place") <= HALO, F.col("dt"))).alias("_floor"))
    first = changes.groupBy("symbol").agg(F.min("dt").alias("_first"))
    far = F.col("_rows").isNull() | (F.col("_rows") == TAIL) & (F.col("_first") <= F.col("_floor"))
    return first.join(reach, "symbol", "left").select("symbol", far.alias("far"))


def gold_from_tail(tail: DataFrame, changes: DataFrame) -> DataFrame:
    """Features of each changed row and of the rows after it. Symbols out of reach are the caller's."""
    marks = changes.select(*KEY).distinct().withColumn("_changed", F.lit(1))
    rows = tail.join(changes.select("symbol").distinct(), "symbol", "left_semi").join(marks, KEY, "left")
    frame = Window.partitionBy("symbol").orderBy("dt").rowsBetween(-HALO, Window.currentRow)
    near = rows.withColumn("_near", F.max("_changed").over(frame))
    return gold_features(near, carry=["_near"]).where(F.col("_near") == 1).select(*GOLD.names)
