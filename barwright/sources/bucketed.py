"""Silver as a Spark bucketed table, for merges in which the base never moves.

Both the table and the changes are written in the same buckets of symbols, sorted by key, so that their
merge reads bucket against bucket: a full outer join without an exchange on either side. Months are
partitions, and a merge rewrites the touched ones only. The catalog knows the table by name; its files
lie in a folder of the caller's.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.functions.dates import month_key
from barwright.schemas import KEY, SILVER
from barwright.session import remove, scratch_dir

# Rows are clustered by symbol and joined by symbol and date; and what is rewritten is the months at hand.
SETTINGS = {
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


@contextlib.contextmanager
def settings(spark: SparkSession) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write_bucketed(silver: DataFrame, name: str, path: str, buckets: int) -> None:
    """Make the table ``name`` of clean rows. The rows of a bucket come together first, so that each month
    has one file for each."""
    rows = silver.select(*SILVER.names).withColumn("ym", month_key(F.col("dt")))
    (rows.repartition(buckets, "symbol").write.mode("overwrite").option("path", path)
     .partitionBy("ym").bucketBy(buckets, "symbol").sortBy(*KEY).saveAsTable(name))


def merged_rows(spark: SparkSession, name: str, changes: str) -> DataFrame:
    """The months of ``name`` that ``changes`` touches, merged: the higher ``seq`` wins, at equal ones the
    change."""
    new = spark.table(changes)
    months = [r["ym"] for r in new.select("ym").distinct().collect()]
    base = spark.table(name).where(F.col("ym").isin(months))
    old, new = (rows.select(*KEY, F.struct(*[c for c in rows.columns if c not in KEY]).alias(side))
                for rows, side in ((base, "_old"), (new, "_new")))
    wins = F.col("_old").isNull() | (F.col("_new.seq") >= F.col("_old.seq"))
    row = F.when(wins & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("_old"))
    return old.join(new, KEY, "full_outer").withColumn("_row", row).select(*KEY, "_row.*").select(
        *SILVER.names, "ym")


def upsert_bucketed(changes: DataFrame, name: str, buckets: int) -> None:
    """Merge clean rows, one for each key, into the table."""
    spark = changes.sparkSession
    path = scratch_dir(spark, "changes")
    staged = f"changes_{path.rsplit('-', 1)[1]}"
    with settings(spark):
        write_bucketed(changes, staged, path, buckets)
        try:
            merged_rows(spark, name, staged).write.mode("overwrite").insertInto(name)
        finally:
            spark.sql(f"DROP TABLE {staged}")
            remove(spark, path)
