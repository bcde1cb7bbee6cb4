"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR names the folder of the tables, BENCH_CPUS the number of local threads. Each query
runs completely into a sink that discards the rows, once to warm up and once for the time.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import functions as F

from barwright.operators.silver import build_silver
from barwright.operators.synth import generate_bars
from barwright.plans import refresh
from barwright.plans.driver_tables import bulk_bronze, feed_bronze
from barwright.plans.registry import QUERIES, RESTATED_SEQ, loaded
from barwright.session import build_session, scratch_dir, staged
from barwright.sources import tables

HEADLINE = [
    "bronze_union", "silver_dedupe", "silver_build", "gold_features", "gold_features_chunked",
    "latest_features", "latest_ranked", "layer_counts", "daily_bars", "completeness_gaps",
    "quality_report", "duplicate_keys", "drift_report", "reconcile", "csv_ingest", "feed_ingest",
    "silver_upsert", "gold_upsert", "medallion_gold", "incremental_gold", "synth_ohlcv_profile",
    "stream_daily_bars", "stream_silver", "stream_gold",
]


def stored_runs(spark, sf_dir: str) -> dict:
    """A month of one symbol corrected in stored tables that hold all rows: work that must not grow with
    the tables."""
    root = scratch_dir(spark, "tables")
    refresh.run(spark, [loaded(feed_bronze(spark, sf_dir), "feed"),
                        loaded(bulk_bronze(spark, sf_dir), "bulk")], root)
    fixes = bulk_bronze(spark, sf_dir).where(
        "symbol = 'S0007' AND dt BETWEEN DATE'1997-03-01' AND DATE'1997-03-31'").withColumn(
        "seq", F.col("seq") + RESTATED_SEQ)

    def increment():
        refresh.run(spark, [loaded(fixes, "fix")], root, full=False)
        return tables.read_months(spark, root, "features_gold", [199703])

    def upsert():
        with staged(build_silver(fixes), "changes") as changes:
            refresh.apply_to_silver(changes, root)
        return tables.read_months(spark, root, "price_silver", [199703])

    return {"increment_of_one_symbol": increment, "upsert_of_one_symbol": upsert}


def timed(make) -> float:
    start = time.perf_counter()
    make().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    runs = {name: lambda name=name: QUERIES[name](spark, sf_dir) for name in HEADLINE}
    # The one workload whose size is published: a million generated rows.
    runs["generate_1m_rows"] = lambda: generate_bars(spark, rows=1_000_000)
    runs |= stored_runs(spark, sf_dir)
    seconds = {}
    for name, make in runs.items():
        timed(make)
        seconds[name] = round(timed(make), 3)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
