"""Bronze to silver: drop incomplete rows, keep one row per key, clamp the volume."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.functions.numeric import non_negative
from barwright.schemas import BAR_COLUMNS, BARS, KEY, PRICE_COLUMNS


def complete_rows(bronze: DataFrame) -> DataFrame:
    """Rows with a value in each of the seven bar columns.

    Written as plain IS NOT NULL terms, which reach the Parquet scan; ``dropna`` does not.
    """
    return bronze.where(is_complete())


def quarantine(bronze: DataFrame) -> DataFrame:
    """The rows :func:`complete_rows` drops, with the names of their empty columns as reason."""
    empty = [F.when(F.col(name).isNull(), F.lit(name)) for name in BAR_COLUMNS]
    return (bronze
            .where(~is_complete())
            .withColumn("reason", F.concat(F.lit("missing: "), F.concat_ws(", ", *empty))))


def is_complete() -> Column:
    complete = F.lit(True)
    for name in BAR_COLUMNS:
        complete = complete & F.col(name).isNotNull()
    return complete


def latest_per_key(rows: DataFrame, before: str | None = None,
                   after: str | None = None) -> DataFrame:
    """One row per (symbol, dt): the highest ``seq``, ties by the larger values.

    A larger value of the column ``before`` wins whatever the ``seq``, one of ``after`` at equal
    ``seq``.

    The order is total up to identical rows, so the result does not depend on partitioning. Spark
    cuts each map task down to one row per key before the shuffle (WindowGroupLimit), so a key that
    holds a large part of the table sends one row per map task and not all its copies.
    """
    order = [before, "seq", after, *PRICE_COLUMNS, "volume"]
    newest = [F.col(name).desc() for name in order if name]
    # Spark sorts by the first eight bytes of the first column and looks further only on a tie.
    # Those bytes tell few symbols apart, a hash of the key tells all keys apart.
    hashed = rows.withColumn("_hash", F.xxhash64(*KEY))
    rank = F.row_number().over(Window.partitionBy("_hash", *KEY).orderBy(*newest))
    return hashed.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank", "_hash")


def clamp_volume(rows: DataFrame) -> DataFrame:
    return rows.withColumn("volume", non_negative(F.col("volume")))


def cast_bars(rows: DataFrame, *extra: str) -> DataFrame:
    """The seven bar columns in their declared types, followed by ``extra`` unchanged."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in BARS.fields], *extra)


def build_silver(bronze: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Silver rows with ``seq``. Incomplete rows go first, so an older complete row beats a newer
    incomplete one.

    ``known`` are silver rows of before: they count only for keys that bronze does not have. They
    go through the same shuffle as one more source, so that takes no join.
    """
    typed = complete_rows(cast_bars(bronze, "seq"))
    if known is None:
        return clamp_volume(latest_per_key(typed))
    both = typed.withColumn("_fresh", F.lit(1)).unionByName(
        known.select(typed.columns).withColumn("_fresh", F.lit(0)))
    return clamp_volume(latest_per_key(both, before="_fresh").drop("_fresh"))
