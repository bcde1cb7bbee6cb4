"""Every operator as a query over the driver's tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barwright.functions import draws
from barwright.functions.dates import month_key
from barwright.operators import (
    bars, calendar, gold, merge, quality, serving, silver, sketches, synth,
)
from barwright.plans import reconcile as reconciling
from barwright.plans import refresh
from barwright.plans.driver_tables import bulk_bronze, feed_bronze, feed_rows, table
from barwright.schemas import BAR_COLUMNS, BRONZE, GOLD, KEY, SILVER
from barwright.session import scratch_dir, staged
from barwright.sources import bucketed, raw, tables
from barwright.sources.extracts import LandedExtracts
from barwright.streaming import bars as stream_bars
from barwright.streaming import late
from barwright.streaming import tables as stream_tables
from barwright.streaming.topics import decode, publish, read_stream, without_redeliveries

QUERIES = {}

RESTATED_DAYS = 7
RESTATED_SEQ = 1_000_000_000_000


def query(function):
    QUERIES[function.__name__] = function
    return function


def both_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return feed_bronze(spark, sf).unionByName(bulk_bronze(spark, sf))


def restated_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A second load of the feed: every row a week later, one unit dearer and newer in ``seq``.

    It meets keys of the first load, adds keys after its last day and leaves its first days alone.
    """
    return dearer(feed_bronze(spark, sf), 1).withColumns({
        "dt": F.date_add("dt", RESTATED_DAYS),
        "seq": F.col("seq") + RESTATED_SEQ,
        "source": F.lit("restated"),
    })


def ticks(rows: DataFrame) -> DataFrame:
    """Trades of the feed for the roll-up: rows with a symbol, volumes filled and clamped."""
    return silver.clamp_volume(rows.where(F.col("symbol").isNotNull())).select(
        "symbol", "ts", F.col("open").alias("price"), F.col("volume").alias("size"), "seq")


def loaded(rows: DataFrame, source: str) -> raw.RawBars:
    """Rows that need no parsing, as a source for a load."""
    none = F.lit(None).cast("string")
    return raw.RawBars(source, rows.select(*BRONZE.names, none.alias("_raw"),
                                           none.alias("_reason")))


# ---- sources and bronze

@query
def csv_ingest(spark, sf):
    folder = scratch_dir(spark, "csv")
    synth.write_csv(bulk_bronze(spark, sf), folder)
    return raw.read_csv_bars(spark, folder).bars


@query
def csv_split(spark, sf):
    """Files of 1000 rows at most, read back as one source."""
    folder = scratch_dir(spark, "csv")
    synth.write_csv(bulk_bronze(spark, sf), folder, split_rows=1000)
    return raw.read_csv_bars(spark, folder).bars


def vendor_extract(spark, sf):
    return feed_rows(table(spark, sf, "events")).select(
        F.col("ts").alias("Datetime"), F.col("symbol").alias("Symbol"),
        F.col("open").alias("Open"), F.col("high").alias("High"), F.col("low").alias("Low"),
        F.col("close").alias("Close"), F.col("close").alias("Adj Close"),
        F.col("volume").alias("Volume"), F.col("seq").alias("Seq"))


@query
def feed_ingest(spark, sf):
    folder = scratch_dir(spark, "feed")
    vendor_extract(spark, sf).write.parquet(folder)
    return raw.read_feed(spark, folder, start="2024-01-01", seq=F.col("seq")).bars


@query
def feed_extracts(spark, sf):
    """The same extract through the data source for landed files."""
    folder = scratch_dir(spark, "feed")
    vendor_extract(spark, sf).write.parquet(folder)
    spark.dataSource.register(LandedExtracts)
    rows = spark.read.format("landed_extracts").option("path", folder).load()
    return raw.feed_bars(rows, start="2024-01-01", seq=F.col("seq")).bars


@query
def feed_single_symbol(spark, sf):
    folder = scratch_dir(spark, "feed")
    vendor_extract(spark, sf).drop("Symbol", "Volume").write.json(folder)
    schema = "Datetime string, Open string, High string, Low string, Close string, Seq bigint"
    return raw.read_feed(spark, folder, symbol="ALL", start="2024-01-01", fmt="json",
                         schema=schema, seq=F.col("seq")).bars


@query
def feed_date_range(spark, sf):
    folder = scratch_dir(spark, "feed")
    vendor_extract(spark, sf).write.parquet(folder)
    return raw.read_feed(spark, folder, start="2024-01-05", end="2024-01-20",
                         seq=F.col("seq")).bars


@query
def feed_intraday_load(spark, sf):
    """The vendor extract, several rows a day, loaded as daily bars and refreshed to silver."""
    folder, root = scratch_dir(spark, "feed"), scratch_dir(spark, "tables")
    vendor_extract(spark, sf).write.parquet(folder)
    refresh.load(raw.read_feed(spark, folder, start="2024-01-01", end="2025-01-01",
                               seq=F.col("seq"), intraday=True), root)
    refresh.refresh_all(spark, root)
    return tables.read_table(spark, root, "price_silver").select(*BAR_COLUMNS)


@query
def bronze_union(spark, sf):
    return both_bronze(spark, sf)


@query
def bronze_append(spark, sf):
    root = scratch_dir(spark, "tables")
    refresh.load(loaded(feed_bronze(spark, sf), "feed"), root, 1)
    refresh.load(loaded(bulk_bronze(spark, sf), "bulk"), root, 1)
    refresh.load(loaded(feed_bronze(spark, sf), "feed"), root, 2)
    return tables.read_table(spark, root, "bronze_price_raw")


# ---- silver

@query
def silver_filter(spark, sf):
    return silver.complete_rows(feed_bronze(spark, sf))


@query
def quarantine(spark, sf):
    return silver.quarantine(feed_bronze(spark, sf))


@query
def volume_clamp(spark, sf):
    return silver.clamp_volume(feed_bronze(spark, sf)).select("symbol", "dt", "seq", "volume")


@query
def silver_dedupe(spark, sf):
    return silver.latest_per_key(bulk_bronze(spark, sf)).drop("source")


@query
def silver_build(spark, sf):
    return silver.build_silver(both_bronze(spark, sf)).select(*BAR_COLUMNS)


def clean(spark, sf):
    return silver.build_silver(both_bronze(spark, sf))


# ---- gold

@query
def gold_features(spark, sf):
    return gold.gold_features(clean(spark, sf))


@query
def gold_features_chunked(spark, sf):
    """On stored silver, as the operator reads it twice."""
    folder = scratch_dir(spark, "silver")
    clean(spark, sf).write.parquet(folder)
    return gold.gold_features_chunked(spark.read.schema(SILVER).parquet(folder), chunk_rows=256)


@query
def ma_close(spark, sf):
    return gold.gold_features(clean(spark, sf)).select(*KEY, "ma3", "ma5", "ma20")


@query
def vol10(spark, sf):
    return gold.gold_features(clean(spark, sf)).select(*KEY, "vol10")


@query
def ret1d(spark, sf):
    return gold.gold_features(clean(spark, sf)).select(*KEY, "ret1d")


# ---- serving

@query
def latest_date(spark, sf):
    return serving.latest_date(clean(spark, sf))


@query
def latest_features(spark, sf):
    """Through the view, which is registered before the tables have any rows."""
    root = scratch_dir(spark, "tables")
    tables.register_views(spark, root)
    refresh.run(spark, [loaded(feed_bronze(spark, sf), "feed")], root)
    refresh.run(spark, [loaded(restated_feed(spark, sf), "restated")], root, full=False)
    return spark.table("latest_features")


@query
def latest_ranked(spark, sf):
    return serving.latest_ranked(gold.gold_features(clean(spark, sf)))


@query
def layer_counts(spark, sf):
    rows = clean(spark, sf)
    return serving.layer_counts({
        "bronze_price_raw": both_bronze(spark, sf),
        "price_silver": rows,
        "features_gold": gold.gold_features(rows),
    })


# ---- merges and refreshes on stored tables

@query
def silver_upsert(spark, sf):
    root = scratch_dir(spark, "tables")
    tables.write_months(silver.build_silver(feed_bronze(spark, sf)), root, "price_silver")
    with staged(silver.build_silver(restated_feed(spark, sf)), "changes") as changes:
        refresh.apply_to_silver(changes, root)
    return tables.read_table(spark, root, "price_silver").select(*SILVER.names)


@query
def silver_upsert_bucketed(spark, sf):
    """The same merge on a bucketed table, whose rows are not shuffled."""
    path = scratch_dir(spark, "bucketed")
    name = f"silver_{path.rsplit('-', 1)[1]}"
    bucketed.write_bucketed(silver.build_silver(feed_bronze(spark, sf)), name, path, 8)
    bucketed.upsert_bucketed(silver.build_silver(restated_feed(spark, sf)), name, 8)
    rows = spark.read.schema(spark.table(name).schema).parquet(path).select(*SILVER.names)
    spark.sql(f"DROP TABLE {name}")
    return rows


@query
def gold_upsert(spark, sf):
    root = scratch_dir(spark, "tables")
    first, second = (gold.gold_features(silver.build_silver(rows(spark, sf)))
                     for rows in (feed_bronze, restated_feed))
    tables.write_months(first, root, "features_gold")
    refresh.upsert_gold(second, root)
    return tables.read_table(spark, root, "features_gold").select(*GOLD.names)


@query
def medallion_gold(spark, sf):
    root = scratch_dir(spark, "tables")
    sources = [loaded(feed_bronze(spark, sf), "feed"), loaded(bulk_bronze(spark, sf), "bulk")]
    refresh.run(spark, sources, root, batch=1)
    return tables.read_table(spark, root, "features_gold").select(*GOLD.names)


@query
def incremental_gold(spark, sf):
    root = scratch_dir(spark, "tables")
    refresh.run(spark, [loaded(feed_bronze(spark, sf), "feed")], root, batch=1)
    refresh.run(spark, [loaded(restated_feed(spark, sf), "restated")], root, batch=2, full=False)
    return tables.read_table(spark, root, "features_gold").select(*GOLD.names)


def dearer(rows, by):
    """The same rows with all prices changed by ``by``."""
    return rows.withColumns({name: (F.col(name) + by).cast(rows.schema[name].dataType)
                             for name in ["open", "high", "low", "close"]})


@query
def refresh_after_replaced_load(spark, sf):
    """A load is replaced by one with lower prices at the same ``seq``: silver follows."""
    root = scratch_dir(spark, "tables")
    refresh.run(spark, [loaded(dearer(feed_bronze(spark, sf), 1), "feed")], root, batch=1)
    tables.replace_bronze_batch(feed_bronze(spark, sf), root, "feed", 1)
    refresh.refresh_all(spark, root)
    return tables.read_table(spark, root, "price_silver").select(*SILVER.names)


@query
def refresh_after_withdrawn_load(spark, sf):
    """A newer load is emptied: its keys fall back to the older load, those it alone had stay."""
    root = scratch_dir(spark, "tables")
    refresh.run(spark, [loaded(feed_bronze(spark, sf), "feed"),
                        loaded(restated_feed(spark, sf), "restated")], root, batch=1)
    tables.replace_bronze_batch(restated_feed(spark, sf).limit(0), root, "restated", 1)
    refresh.refresh_all(spark, root)
    return tables.read_table(spark, root, "price_silver").select(*SILVER.names)


@query
def late_correction_wins(spark, sf):
    """Two loads of CSV files without a batch: the later one wins with lower prices."""
    root, rows = scratch_dir(spark, "tables"), silver.build_silver(feed_bronze(spark, sf))
    for by in (0, -1):
        folder = scratch_dir(spark, "csv")
        synth.write_csv(dearer(rows, by), folder)
        refresh.load_csv_to_bronze(spark, folder, root)
        refresh.refresh_increment(spark, root)
    return tables.read_table(spark, root, "price_silver").select(*BAR_COLUMNS)


@query
def refresh_twice(spark, sf):
    root = scratch_dir(spark, "tables")
    refresh.run(spark, [loaded(feed_bronze(spark, sf), "feed")], root)
    refresh.refresh_all(spark, root)
    return tables.read_table(spark, root, "features_gold").select(*GOLD.names)


@query
def refresh_after_compaction(spark, sf):
    """A load is gathered with others and then replaced by one with lower prices: silver follows."""
    root = scratch_dir(spark, "tables")
    for rows in (dearer(feed_bronze(spark, sf), 1), restated_feed(spark, sf)):
        refresh.run(spark, [loaded(rows, "feed")], root, full=False)
    if tables.compact_bronze(spark, root, "feed") != 1:
        raise ValueError("the first load should have been gathered")
    tables.replace_bronze_batch(feed_bronze(spark, sf), root, "feed", 1)
    refresh.refresh_all(spark, root)
    return tables.read_table(spark, root, "price_silver").select(*SILVER.names)


@query
def gold_from_tail(spark, sf):
    """The last month comes as an increment: its features need the tail of silver only."""
    root, rows = scratch_dir(spark, "tables"), bulk_bronze(spark, sf)
    new = F.col("dt") >= F.date_sub(rows.agg(F.max("dt")).scalar(), 14)
    refresh.run(spark, [loaded(rows.where(~new), "bulk")], root)
    refresh.run(spark, [loaded(rows.where(new), "bulk")], root, full=False)
    return tables.read_table(spark, root, "features_gold").select(*GOLD.names)


@query
def latest_maintained(spark, sf):
    """The kept newest features after a late correction, and after that load was withdrawn."""
    root, shown = scratch_dir(spark, "tables"), scratch_dir(spark, "latest")

    def show(step):
        if not tables.is_kept(spark, root, "gold_latest"):
            raise ValueError("the newest features should be kept")
        tables.latest_rows(spark, root).withColumn("step", F.lit(step)).write.mode("append").parquet(shown)

    refresh.run(spark, [loaded(feed_bronze(spark, sf), "feed")], root)
    refresh.run(spark, [loaded(restated_feed(spark, sf), "restated")], root, full=False)
    show("corrected")
    tables.replace_bronze_batch(restated_feed(spark, sf).limit(0), root, "restated", 2)
    refresh.refresh_all(spark, root)
    show("withdrawn")
    return spark.read.parquet(shown)


@query
def gate_stops_refresh(spark, sf):
    """A limit on incomplete rows stops the refresh before silver has any row; without it, it runs."""
    root, rows = scratch_dir(spark, "tables"), []
    refresh.load(loaded(feed_bronze(spark, sf), "feed"), root)
    for limits in ({"incomplete": 0.0}, None):
        try:
            refresh.refresh_all(spark, root, limits)
            stopped = False
        except quality.QualityError:
            stopped = True
        rows.append((stopped, tables.read_table(spark, root, "price_silver").count()))
    return spark.createDataFrame(rows, "stopped boolean, silver_rows long")


@query
def load_states(spark, sf):
    """What the state has of loads: one pending, one worked in, and the newest of many micro-batches."""
    root = streamed_silver(spark, sf)
    refresh.run(spark, [loaded(bulk_bronze(spark, sf), "bulk")], root, full=False)
    refresh.load(loaded(restated_feed(spark, sf), "restated"), root)
    return tables.loads(spark, root)


@query
def load_counts(spark, sf):
    """Rows that each load brought, as the loads counted them."""
    root = scratch_dir(spark, "tables")
    counts = [(name, refresh.load(loaded(rows, name), root)) for name, rows in
              (("feed", feed_bronze(spark, sf)), ("bulk", bulk_bronze(spark, sf)))]
    return spark.createDataFrame(counts, "source string, n_rows long")


# ---- bars, calendar, generator

@query
def daily_bars(spark, sf):
    return bars.daily_bars(ticks(feed_rows(table(spark, sf, "events"))))


@query
def intraday_rollup(spark, sf):
    rows = feed_rows(table(spark, sf, "events"))
    return bars.roll_up(silver.clamp_volume(silver.complete_rows(rows)))


@query
def business_calendar(spark, sf):
    return calendar.business_calendar(bulk_bronze(spark, sf))


@query
def completeness_gaps(spark, sf):
    return calendar.completeness_gaps(clean(spark, sf))


@query
def synth_ohlcv_profile(spark, sf):
    """A series for every supplier over the business days of the orders."""
    days = calendar.business_calendar(
        table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("dt")))
    first, periods = days.agg(F.min("dt"), F.count(F.lit(1))).first()
    number = F.col("s_suppkey")
    symbols = table(spark, sf, "supplier").select(
        F.format_string("SYM%04d", number + 1).alias("symbol"), synth.start_price(number))
    return synth.profile(synth.synth_bars(symbols, periods, first))


@query
def synth_walk(spark, sf):
    """The generator's walk with changes, gaps and spreads out of table columns."""
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice",
             "l_discount", "l_tax"]
    days = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("symbol"),
        (F.row_number().over(Window.partitionBy("l_suppkey").orderBy(*order)) - 1).alias("i"),
        (100.0 / 3 + F.col("l_suppkey") * synth.PRICE_STEP).alias("start_price"),
        ((F.col("l_discount") - 0.05) / 7).alias("change"),
        ((F.col("l_tax") - 0.04) / 90).alias("gap"), (F.col("l_quantity") / 9000).alias("spread"))
    return synth.walk(days).select("symbol", "i", "open", "high", "low", "close")


@query
def draw_moments(spark, sf):
    """Of every draw of the generator, over the line items: its number, and whether mean, deviation and
    range are what is asked for (within five standard errors)."""
    here = [F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    low, high = synth.VOLUME_LOW, synth.VOLUME_HIGH
    normals = {"change": (synth.DRIFT, synth.VOLATILITY), "gap": (0.0, synth.GAP_STDDEV),
               "spread": (synth.SPREAD_MEAN, synth.SPREAD_STDDEV)}
    asked = {name: (draws.normal(mean, spread, 42, name, *here), mean, spread, None)
             for name, (mean, spread) in normals.items()} | {
        "volume": (draws.integer(low, high, 42, "volume", *here), (low + high - 1) / 2,
                   (high - low) / 12 ** 0.5, (low, high - 1)),
        "uniform": (draws.uniform(42, "uniform", *here), 0.5, 12 ** -0.5, (0.0, 1.0)),
    }
    rows = table(spark, sf, "lineitem").select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("draw"), value.cast("double").alias("value"),
                 F.lit(mean).cast("double").alias("mean"), F.lit(spread).cast("double").alias("spread"),
                 F.lit(bounds[0] if bounds else float("-inf")).cast("double").alias("low"),
                 F.lit(bounds[1] if bounds else float("inf")).cast("double").alias("high"))
        for name, (value, mean, spread, bounds) in asked.items()])).alias("d")).select("d.*")
    error = F.first("spread") / F.sqrt(F.count("*"))
    return rows.groupBy("draw").agg(
        F.count("*").alias("n"),
        (F.abs(F.avg("value") - F.first("mean")) < 5 * error).alias("mean_fits"),
        (F.abs(F.stddev_samp("value") - F.first("spread")) < 5 * error).alias("deviation_fits"),
        F.bool_and(F.col("value").between(F.col("low"), F.col("high"))).alias("range_fits"))


# ---- quality

def exact_drift(bars: DataFrame, found: DataFrame, split: int) -> DataFrame:
    """For each symbol of ``found`` how many closes of a side are up to and below its median, and the
    largest difference of ranks at any close."""
    sides = {"ref": month_key(F.col("dt")) < split, "cur": month_key(F.col("dt")) >= split}
    rows = bars.select("symbol", F.col("close").cast("double").alias("close"),
                       *[here.alias(f"is_{side}") for side, here in sides.items()])
    whole = Window.partitionBy("symbol")
    upto = whole.orderBy("close").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranks = [F.count_if(f"is_{side}").over(upto) / F.nullif(F.count_if(f"is_{side}").over(whole), F.lit(0))
             for side in sides]
    counts = [F.count_if(F.col(f"is_{side}") & condition).alias(f"{name}_{side}") for side in sides
              for name, condition in (("upto", F.col("close") <= F.col(f"median_{side}")),
                                      ("below", F.col("close") < F.col(f"median_{side}")))]
    return rows.withColumn("gap", F.abs(ranks[0] - ranks[1])).join(
        found.select("symbol", "median_ref", "median_cur"), "symbol").groupBy("symbol").agg(
        *counts, F.max("gap").alias("exact"))


@query
def drift_sketch(spark, sf):
    """Drift from stored sketches of symbols and months, and whether its medians and distances agree
    with exact ranks."""
    root, split, error = scratch_dir(spark, "tables"), 199600, 2 * sketches.RANK_ERROR
    tables.write_months(clean(spark, sf), root, "price_silver")
    refresh.refresh_price_sketches(spark, root)
    found = sketches.drift_from_sketches(refresh.read_price_sketches(spark, root),
                                         sketches.in_months(None, split), sketches.in_months(split, None))
    medians = [(F.col(f"n_{side}") == 0)
               | ((F.col(f"upto_{side}") >= (0.5 - error) * F.col(f"n_{side}"))
                  & (F.col(f"below_{side}") <= (0.5 + error) * F.col(f"n_{side}")))
               for side in ("ref", "cur")]
    off = F.coalesce(F.col("exact") - F.col("distance"), F.lit(0.0))
    return found.join(exact_drift(tables.read_table(spark, root, "price_silver"), found, split),
                      "symbol").select(
        "symbol", "n_ref", "n_cur", (medians[0] & medians[1]).alias("medians_fit"),
        (F.abs(off) <= sketches.DISTANCE_ERROR).alias("distance_fits"))


@query
def duplicate_rate_sketch(spark, sf):
    """Rows per key from stored sketches of loads and months, and whether it is within 2 % of the exact."""
    root = scratch_dir(spark, "tables")
    for number, rows in enumerate((feed_bronze, bulk_bronze, feed_bronze), 1):
        refresh.load(loaded(rows(spark, sf), rows.__name__.split("_")[0]), root, number)
    loads = [("feed", 1), ("bulk", 2), ("feed", 3)]
    refresh.refresh_key_sketches(spark, root, loads[:2])
    refresh.refresh_key_sketches(spark, root, loads[2:])
    found = sketches.duplicate_rate_from_sketches(refresh.read_key_sketches(spark, root))
    exact = quality.duplicate_rate(tables.read_table(spark, root, "bronze_price_raw")).select(
        "source", F.col("rows_per_key").alias("exact"))
    return found.join(exact, "source").select(
        "source", "n_rows", (F.abs(F.col("rows_per_key") / F.col("exact") - 1)
                             <= sketches.KEY_ERROR).alias("rate_fits"))


@query
def quality_report(spark, sf):
    return quality.quality_report(feed_bronze(spark, sf))


@query
def duplicate_keys(spark, sf):
    return merge.duplicate_keys(both_bronze(spark, sf))


@query
def ohlc_sanity(spark, sf):
    return quality.ohlc_violations(clean(spark, sf)).select(*BAR_COLUMNS)


@query
def drift_report(spark, sf):
    rows = both_bronze(spark, sf)
    return quality.drift_report(rows, quality.middle_date(rows))


@query
def duplicate_rate(spark, sf):
    return quality.duplicate_rate(both_bronze(spark, sf))


@query
def reconcile(spark, sf):
    """Gold was built before the bulk source came, so its keys are missing there."""
    early = gold.gold_features(silver.build_silver(feed_bronze(spark, sf)))
    return quality.reconcile_layers(both_bronze(spark, sf), clean(spark, sf), early)


@query
def reconcile_digest(spark, sf):
    """The same on stored tables: folders whose digests agree are not opened."""
    root = scratch_dir(spark, "tables")
    refresh.run(spark, [loaded(feed_bronze(spark, sf), "feed")], root)
    reconciling.refresh_digests(spark, root)
    refresh.load(loaded(bulk_bronze(spark, sf), "bulk"), root)
    refresh.refresh_silver(spark, root)
    return reconciling.reconcile_by_digest(spark, root)


@query
def reconcile_tables(spark, sf):
    before, after = (silver.build_silver(rows(spark, sf)).select(*BAR_COLUMNS)
                     for rows in (feed_bronze, restated_feed))
    return quality.reconcile_tables(before, after)


# ---- streams

def event_stream(spark, sf):
    """The events as a stream. The glob fits a single file as well as a folder of files."""
    schema = table(spark, sf, "events").schema
    return read_stream(spark, f"{sf}/events.parque[t]", schema)


@query
def stream_daily_bars(spark, sf):
    root = scratch_dir(spark, "stream")
    stream_bars.write_daily_bars(ticks(feed_rows(event_stream(spark, sf))),
                                 f"{root}/checkpoint", path=f"{root}/bars").awaitTermination()
    return spark.read.parquet(f"{root}/bars")


@query
def stream_reconcile(spark, sf):
    """Streamed bars against the batch: closed days agree, open ones are in the batch only."""
    return quality.reconcile_summary(stream_daily_bars(spark, sf), daily_bars(spark, sf))


@query
def stream_late_rows(spark, sf):
    """Odd events come after all even ones: most are too late for their bars, and are kept. Counts of
    bars, late rows and rows of open days."""
    root = scratch_dir(spark, "stream")
    events = table(spark, sf, "events")
    for odd in range(2):
        events.where(F.col("event_id") % 2 == odd).coalesce(1).write.mode("append").parquet(f"{root}/events")
    stream = ticks(feed_rows(read_stream(spark, f"{root}/events", events.schema, maxFilesPerTrigger="1")))
    late.stream_bars_and_late_rows(stream, root, f"{root}/checkpoint",
                                   datetime.timedelta(days=2)).awaitTermination()
    counts = [("bars", late.read_stream_bars(spark, root).count()),
              *((name, late.read_rows(spark, root, name, stream.schema).count())
                for name in ("late_rows", "open_rows"))]
    return spark.createDataFrame(counts, "kind string, n long")


def streamed_silver(spark, sf):
    """The events in three files, a micro-batch each, so that later ones merge into earlier ones."""
    root = scratch_dir(spark, "stream")
    events = table(spark, sf, "events")
    events.repartition(3, "event_id").write.parquet(f"{root}/events")
    stream = read_stream(spark, f"{root}/events", events.schema, maxFilesPerTrigger="1")
    rows = silver.cast_bars(feed_rows(stream), F.lit("feed").alias("source"), "seq")
    stream_tables.stream_silver(rows, root, "feed", f"{root}/checkpoint-silver").awaitTermination()
    return root


@query
def stream_silver(spark, sf):
    root = streamed_silver(spark, sf)
    return tables.read_table(spark, root, "price_silver").select(*SILVER.names)


@query
def stream_redelivery(spark, sf):
    """Every message comes twice, in files of its own: repeats are dropped by state, the rest merged."""
    root = scratch_dir(spark, "stream")
    events = table(spark, sf, "events")
    for copy in range(2):
        events.repartition(2, "event_id").write.mode("append").parquet(f"{root}/events")
    stream = read_stream(spark, f"{root}/events", events.schema, maxFilesPerTrigger="2")
    rows = silver.cast_bars(feed_rows(without_redeliveries(stream, "ts", "365 days", "event_id")),
                            F.lit("feed").alias("source"), "seq")
    stream_tables.stream_silver(rows, root, "feed", f"{root}/checkpoint").awaitTermination()
    counts = [(name, tables.read_table(spark, root, name).count())
              for name in ("bronze_price_raw", "price_silver")]
    return spark.createDataFrame(counts, "layer string, n_rows long")


@query
def topic_gold(spark, sf):
    """Messages of raw prices to silver and gold in one stream, and both layers out as messages; the
    last message of a key and date is the result. Each load of the topic has two files, as of two
    partitions, so that the micro-batches are as many at any size."""
    root = scratch_dir(spark, "stream")
    topic = {name: {"format": "parquet", "path": f"{root}/topic-{name}"}
             for name in ("raw", "silver", "gold")}
    for part in range(3):
        publish(feed_bronze(spark, sf).where(F.col("seq") % 3 == part).repartition(2, "symbol"), topic["raw"])
    messages = read_stream(spark, topic["raw"]["path"], spark.read.parquet(topic["raw"]["path"]).schema,
                           maxFilesPerTrigger="2")
    stream_tables.stream_silver(decode(messages, BRONZE), root, "prices", f"{root}/checkpoint",
                                with_gold=True, topic=topic["silver"],
                                gold_topic=topic["gold"]).awaitTermination()
    sent = decode(spark.read.parquet(topic["gold"]["path"]), GOLD).select(*KEY).distinct()
    return tables.read_table(spark, root, "features_gold").select(*GOLD.names).join(sent, KEY)


@query
def stream_gold(spark, sf):
    root = streamed_silver(spark, sf)
    stream_tables.stream_gold(spark, root, f"{root}/checkpoint-gold",
                              maxFilesPerTrigger="1").awaitTermination()
    return tables.read_table(spark, root, "features_gold").select(*GOLD.names)
