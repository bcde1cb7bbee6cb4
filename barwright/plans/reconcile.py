"""Reconciliation of the stored layers by digests of their folders.

The digest of a month and bucket is the number of its keys and the sum of their hashes, whatever their
order. Digests are kept with the names of the files that they were made from, so a call makes them for
folders that were written since only. Layers whose digests agree in a folder hold the same keys there; only
folders that differ are opened and compared key by key.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwright.functions.dates import month_key
from barwright.operators.quality import reconcile_layers
from barwright.operators.silver import complete_rows
from barwright.schemas import BRONZE, KEY, few_rows
from barwright.session import staged
from barwright.sources.tables import (
    BRONZE_TABLE, bucket_of, buckets, read_parts, read_table, table_exists, table_path,
)

DIGESTS = "layer string, ym int, bucket int, files string, n_keys long, total decimal(38,0)"
LAYERS = {"bronze": BRONZE_TABLE, "silver": "price_silver", "gold": "features_gold"}
PART = ["ym", "bucket"]


def _signature(names: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(names)).encode()).hexdigest()


def folder_files(rows: DataFrame) -> dict[tuple[int, int], str]:
    """What stands for the files of each month and bucket: it changes with any write."""
    names: dict[tuple[int, int], list[str]] = {}
    for file in rows.inputFiles():
        month, bucket, name = re.search(r"ym=(-?\d+)/bucket=(\d+)/([^/]+)$", file).groups()
        names.setdefault((int(month), int(bucket)), []).append(name)
    return {part: _signature(files) for part, files in names.items()}


def _digest(keys: DataFrame) -> DataFrame:
    return keys.groupBy(*PART).agg(F.count(F.lit(1)).alias("n_keys"), F.sum(
        F.xxhash64(*KEY).cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"))


def _with_part(rows: DataFrame, root: str) -> DataFrame:
    return rows.withColumn("ym", month_key(F.col("dt"))).withColumn(
        "bucket", bucket_of(F.col("symbol"), buckets(rows.sparkSession, root)))


def bronze_keys(spark: SparkSession, root: str) -> DataFrame:
    """The different keys of complete rows, with their month and bucket."""
    rows = complete_rows(read_table(spark, root, BRONZE_TABLE).select(*BRONZE.names))
    return _with_part(rows.select(*KEY).distinct(), root)


def known_digests(spark: SparkSession, root: str) -> DataFrame:
    if not table_exists(spark, root, "digests"):
        return few_rows(spark, [], DIGESTS)
    return spark.read.schema(DIGESTS).parquet(table_path(root, "digests"))


def refresh_digests(spark: SparkSession, root: str) -> DataFrame:
    """The digests of all layers; those of folders that did not change are not made again."""
    fresh, kept = [], []
    known = known_digests(spark, root)
    for layer, name in LAYERS.items():
        own = known.where(F.col("layer") == layer)
        if layer == "bronze":
            # Loads overlap, so there is no digest of a part of them.
            files = {(0, 0): _signature(read_table(spark, root, name).inputFiles())}
            if own.where(F.col("files") == files[0, 0]).isEmpty():
                fresh.append(_digest(bronze_keys(spark, root)).withColumn("files", F.lit(files[0, 0]))
                             .withColumn("layer", F.lit(layer)))
            else:
                kept.append(own)
            continue
        now = few_rows(spark, [(*part, files) for part, files in folder_files(
            read_table(spark, root, name)).items()], "ym int, bucket int, files string")
        same = own.join(now, [*PART, "files"], "left_semi")
        kept.append(same)
        stale = [tuple(r) for r in now.join(own, [*PART, "files"], "left_anti").select(*PART).collect()]
        if stale:
            fresh.append(_digest(read_parts(spark, root, name, stale)).join(now, PART).withColumn(
                "layer", F.lit(layer)))
    columns = [f.split()[0] for f in DIGESTS.split(", ")]
    if fresh:
        rows = kept[0] if kept else fresh.pop()
        for more in [*kept[1:], *fresh]:
            rows = rows.select(columns).unionByName(more.select(columns))
        # What is kept is read from the table that is replaced.
        with staged(rows.select(columns).coalesce(1), "digests") as ready:
            ready.coalesce(1).write.mode("overwrite").parquet(table_path(root, "digests"))
    return known_digests(spark, root)


def differing_parts(digests: DataFrame, left: str, right: str) -> set[tuple[int, int]]:
    """Months and buckets whose keys differ between two layers: no more than there are folders."""
    sides = digests.where(F.col("layer").isin(left, right)).groupBy(*PART).agg(
        F.count(F.lit(1)).alias("n"), F.min("n_keys").alias("a"), F.max("n_keys").alias("b"),
        F.min("total").alias("c"), F.max("total").alias("d"))
    return {tuple(r) for r in sides.where("n < 2 OR a <> b OR c <> d").select(*PART).collect()}


def reconcile_by_digest(spark: SparkSession, root: str) -> DataFrame:
    """Keys that are not in all three layers, as :func:`reconcile_layers` gives them. Bronze is read only
    for folders where its keys are not those of silver."""
    digests = refresh_digests(spark, root)
    unlike = differing_parts(digests, "bronze", "silver")
    parts = sorted(unlike | differing_parts(digests, "silver", "gold"))
    silver, gold = (read_parts(spark, root, LAYERS[layer], parts).select(*KEY)
                    for layer in ("silver", "gold"))
    bronze = read_parts(spark, root, LAYERS["silver"], set(parts) - unlike).select(*KEY)
    if unlike:
        here = few_rows(spark, sorted(unlike), "ym int, bucket int")
        bronze = bronze.unionByName(bronze_keys(spark, root).join(here, PART, "left_semi").select(*KEY))
    columns = [c for c in BRONZE.names if c not in KEY]
    filled = bronze.withColumns({c: F.lit("0").cast(BRONZE[c].dataType) for c in columns})
    return reconcile_layers(filled, silver, gold)
