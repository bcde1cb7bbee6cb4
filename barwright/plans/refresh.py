"""Loads and refreshes of the stored tables.

A full refresh recomputes silver from all of bronze and gold from all of silver. An incremental
refresh gives the same tables while reading one load and the months it touches.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from barwright.functions.dates import month_key
from barwright.operators.gold import HALO, gold_features
from barwright.operators.merge import DuplicateKeyError, merge_keyed, merge_latest
from barwright.operators.quality import QualityError, check_counts, enforce_constraints
from barwright.operators.serving import latest_ranked
from barwright.operators.silver import build_silver, quarantine
from barwright.operators.sketches import key_sketches, price_sketches
from barwright.operators.tail import (
    advance_tail, gold_from_tail, last_rows, reach_of_tail, within_tail,
)
from barwright.schemas import BRONZE, GOLD, KEY, SILVER
from barwright.session import staged
from barwright.sources.raw import EmptySourceError, RawBars, read_csv_bars, read_feed
from barwright.sources.tables import (
    any_stored, append_bronze, bucket_of, buckets, check_schemas, finish_move, is_kept, keep, load_number, load_path,
    note_loads, pending_loads, read_bronze_loads, read_buckets, read_months, read_parts, read_table,
    settle_buckets, stored_months, table_exists, table_path, touched_parts, views_at_the_end, write_buckets, write_months,
)


@dataclass
class Refresh:
    """Rows written per layer, and the counts of the quality checks on silver."""

    silver_rows: int = 0
    gold_rows: int = 0
    quality: dict[str, int] = field(default_factory=dict)


def load(raw: RawBars, root: str, batch: int | None = None, strict: bool = False) -> int:
    """Append a source to bronze and return the number of rows loaded.

    Without ``batch`` the load gets the next number over all sources. Bad rows go to
    ``bronze_rejects`` first (a pass made only if the first one counted any), so that rows are never
    in bronze without their rejects; with ``strict`` a bad row stops the load before anything is
    written. An empty source is an error. A load that succeeded is noted as pending.
    """
    spark = raw.parsed.sparkSession
    if batch is None:
        batch = load_number(spark, root)
    counts = raw.parsed.agg(F.count("*"), F.count("_reason"), F.approx_count_distinct(
        month_key(F.col("dt")))).first()
    if not counts[0]:
        raise EmptySourceError(f"the source {raw.source} has no rows")
    settle_buckets(spark, root, counts[0] / max(1, counts[2]))
    note_loads(spark, root, [(batch, raw.source, batch)], "started")
    if counts[1] and not strict:
        raw.bad.write.mode("append").parquet(load_path(root, "bronze_rejects", raw.source, batch))
    rows = append_bronze(raw.strict if strict else raw.bars, root, raw.source, batch)
    note_loads(spark, root, [(batch, raw.source, batch)], "loaded")
    return rows


def load_csv_to_bronze(spark: SparkSession, path: str, root: str, batch: int | None = None,
                       source: str = "csv", strict: bool = False) -> int:
    """Load CSV files; a later load wins over an earlier one for the same symbol and date."""
    batch = load_number(spark, root) if batch is None else batch
    return load(read_csv_bars(spark, path, source, seq=batch), root, batch, strict)


def load_feed_to_bronze(spark: SparkSession, path: str, root: str, symbol: str, start: str,
                        end: str | None = None, fmt: str = "parquet", batch: int | None = None,
                        source: str = "feed", strict: bool = False, intraday: bool = False) -> int:
    """Load the landed extracts of one symbol for ``start`` up to but not including ``end``.

    ``intraday`` rolls extracts with several rows a day up to daily bars, by their times.
    """
    batch = load_number(spark, root) if batch is None else batch
    raw = read_feed(spark, path, symbol, start, end, fmt, source, seq=batch, intraday=intraday)
    return load(raw, root, batch, strict)


def refresh_silver(spark: SparkSession, root: str) -> dict[str, int]:
    """Rebuild silver from all of bronze, whatever silver held for its keys; rows of keys that only
    silver still has stay."""
    bronze = read_table(spark, root, "bronze_price_raw").select(*SILVER.names)
    known = read_table(spark, root, "price_silver").select(*SILVER.names)
    return _write_silver(build_silver(bronze, known), root)


def _write_silver(silver: DataFrame, root: str) -> dict[str, int]:
    return write_months(enforce_constraints(silver), root, "price_silver", check_counts())


def refresh_tail(spark: SparkSession, root: str) -> None:
    """Make the tail of silver anew."""
    silver = read_table(spark, root, "price_silver").select(*SILVER.names)
    write_buckets(last_rows(silver), root, "silver_tail")
    keep(spark, root, "silver_tail")


def refresh_latest(spark: SparkSession, root: str) -> None:
    """Make the newest features anew, in one scan of gold."""
    gold = read_table(spark, root, "features_gold").select(*GOLD.names)
    write_buckets(latest_ranked(gold), root, "gold_latest")
    keep(spark, root, "gold_latest")


def refresh_gold(spark: SparkSession, root: str, keep_orphans: bool = True) -> int:
    """Rebuild gold from all of silver.

    ``keep_orphans`` keeps gold rows whose silver row was removed by hand; where nobody does that,
    leaving it out saves a join of both tables.
    """
    silver = read_table(spark, root, "price_silver")
    gold = gold_features(silver, unique=True)
    if keep_orphans:
        # Gold has the keys of silver, so they are read there instead of made again.
        known = read_table(spark, root, "features_gold").select(*GOLD.names)
        gold = known.join(silver.select(*KEY), KEY, "left_anti").select(*GOLD.names) \
            .unionByName(gold)
    return write_months(enforce_constraints(gold, KEY), root, "features_gold")["rows"]


def refresh_all(spark: SparkSession, root: str,
                limits: dict[str, float] | None = None) -> Refresh:
    """Silver from all of bronze, gold from all of silver; every load then counts as worked in.

    Incomplete rows of bronze are stored in ``quarantine`` and counted. ``limits`` names checks
    (those of ``row_checks``, or ``incomplete``) and the share of rows that may fail each; above one
    the refresh stops before silver is touched.
    """
    finish_move(spark, root)
    check_schemas(spark, root)
    pending = pending_loads(spark, root)
    with ThreadPoolExecutor(2) as beside, views_at_the_end(spark):
        set_aside = beside.submit(refresh_quarantine, spark, root)
        quality = (_gated_silver(spark, root, limits, set_aside) if limits
                   else refresh_silver(spark, root))
        tail = beside.submit(refresh_tail, spark, root)
        done = Refresh(quality["rows"], refresh_gold(spark, root), quality)
        refresh_latest(spark, root)
        tail.result()
        quality["incomplete"] = set_aside.result()
        note_loads(spark, root, pending, "applied")
    return done


def refresh_quarantine(spark: SparkSession, root: str) -> int:
    """Store the incomplete rows of bronze and return how many they are."""
    counted = Observation()
    rows = quarantine(read_table(spark, root, "bronze_price_raw").select(*BRONZE.names))
    rows.observe(counted, F.count("*").alias("incomplete")).write.mode("overwrite").parquet(
        table_path(root, "quarantine"))
    return counted.get["incomplete"]


def _gated_silver(spark: SparkSession, root: str, limits: dict[str, float],
                  set_aside: Future[int]) -> dict[str, int]:
    """:func:`refresh_silver`, if no limit is exceeded: silver is built once, beside the table, and counted
    as it is."""
    read, found = Observation(), Observation()
    bronze = read_table(spark, root, "bronze_price_raw").select(*SILVER.names).observe(
        read, F.count(F.lit(1)).alias("rows"))
    known = read_table(spark, root, "price_silver").select(*SILVER.names)
    with staged(build_silver(bronze, known).observe(found, *check_counts()), "silver") as rows:
        counts = found.get | {"incomplete": set_aside.result()}
        total = {"incomplete": read.get["rows"]}
        over = {name: counts[name] for name, share in limits.items()
                if counts[name] > share * total.get(name, counts["rows"])}
        if over:
            raise QualityError(f"more rows fail than allowed: {over}")
        return _write_silver(rows, root)


def run(spark: SparkSession, sources: list[RawBars], root: str, batch: int | None = None,
        strict: bool = False, full: bool = True) -> Refresh:
    """Load the sources side by side, then silver, then gold. All loads must succeed first.

    Without ``batch`` each source gets a number of its own. With ``full`` off only the new loads are
    worked into silver and gold.
    """
    first = load_number(spark, root, count=max(1, len(sources))) if batch is None else batch
    numbers = [first + (i if batch is None else 0) for i in range(len(sources))]
    with ThreadPoolExecutor(max(1, len(sources))) as pool:
        list(pool.map(lambda raw, number: load(raw, root, number, strict), sources, numbers))
    if full:
        return refresh_all(spark, root)
    return refresh_increment(
        spark, root, [(raw.source, number) for raw, number in zip(sources, numbers)])


def refresh_increment(spark: SparkSession, root: str,
                      loads: list[tuple[str, int]] | None = None) -> Refresh:
    """Bring silver and gold up to date with (source, batch) loads of bronze; with all loads that
    no refresh has worked in yet, if none are named."""
    pending = pending_loads(spark, root)
    if loads is None:
        loads = [(source, batch) for _, source, batch in pending]
    if not loads:
        return Refresh()
    finish_move(spark, root)
    check_schemas(spark, root)
    new = read_bronze_loads(spark, root, loads).select(*BRONZE.names)
    with staged(build_silver(new), "silver-changes") as changes, views_at_the_end(spark):
        parts = touched_parts(changes, root)
        with new_symbols(changes, root, parts) as first:
            quality = apply_to_silver(changes, root, parts, unique=True)
            gold = apply_to_gold(changes, root, parts=parts, first=first)
        done = Refresh(quality.get("rows", 0), gold, quality)
        note_loads(spark, root, [entry for entry in pending if entry[1:] in loads], "applied")
    return done


Parts = list[tuple[int, int]]


@contextlib.contextmanager
def new_symbols(changes: DataFrame, root: str, parts: Parts) -> Iterator[DataFrame | None]:
    """The symbols of ``changes`` that silver has no row of yet, as its tail tells before they are merged;
    None if there are none or no tail is kept. All rows of such a symbol are in ``changes``."""
    spark = changes.sparkSession
    if not parts:
        yield None
        return
    symbols = changes.select("symbol").distinct()
    if table_exists(spark, root, "price_silver"):
        if not is_kept(spark, root, "silver_tail"):
            yield None
            return
        tail = read_buckets(spark, root, "silver_tail", {bucket for _, bucket in parts})
        symbols = symbols.join(tail.select("symbol"), "symbol", "left_anti")
    counted = Observation()
    with staged(symbols.observe(counted, F.count(F.lit(1)).alias("n")), "new-symbols") as found:
        yield found if counted.get["n"] else None


def apply_to_silver(changes: DataFrame, root: str, parts: Parts | None = None,
                    unique: bool = False) -> dict[str, int]:
    """Merge clean rows into the buckets of silver they touch, and into its tail. ``changes`` must be
    a written table; ``parts`` are its months and buckets, where they are known. With ``unique`` the
    caller has seen to it that no key is repeated in ``changes``: they need no shuffle where silver
    has nothing to merge them with.

    The tail counts as out of date until it is written as well, so that one which a lost driver left
    behind is never read.
    """
    spark = changes.sparkSession
    parts = touched_parts(changes, root) if parts is None else parts
    if not parts:
        return {}
    follows = is_kept(spark, root, "silver_tail") or not table_exists(spark, root, "price_silver")
    changes = changes.select(*SILVER.names)
    if unique and not any_stored(spark, root, "price_silver", parts):
        merged = changes
    else:
        known = read_parts(spark, root, "price_silver", parts)
        merged = merge_latest(known.select(*SILVER.names), changes)
    counts = _write_silver(merged, root)
    if follows:
        tail = read_buckets(spark, root, "silver_tail", {bucket for _, bucket in parts}).drop("bucket")
        _follow(spark, root, "silver_tail", within_tail(tail, changes),
                lambda: advance_tail(tail, changes, unique))
    return counts


def _follow(spark: SparkSession, root: str, name: str, news: DataFrame,
            after: Callable[[], DataFrame]) -> None:
    """Write the buckets of a small table as they are ``after`` a change, if the change has ``news`` for
    it, and count it as kept. They are read before the write's commit replaces them."""
    if not news.isEmpty():
        write_buckets(after(), root, name)
    keep(spark, root, name)


def apply_to_gold(changes: DataFrame, root: str, then: Callable[[DataFrame], None] | None = None,
                  parts: Parts | None = None, first: DataFrame | None = None) -> int:
    """Recompute the gold rows that the silver rows at the keys of ``changes`` have an effect on.

    The tail of silver has what new days and corrections of the last ones need; months are read for
    symbols that were corrected further back only. Symbols named in ``first`` (:func:`new_symbols`) have
    no other rows than those of ``changes``, which then has the columns of silver, each key once: their
    features need no stored row.
    """
    spark = changes.sparkSession
    keys = changes.select(*KEY)
    parts = touched_parts(keys, root) if parts is None else parts
    if not parts:
        return 0
    found = []
    if first is not None:
        found = [gold_features(changes.join(first, "symbol", "left_semi"))]
        keys = keys.join(first, "symbol", "left_anti")
        parts = touched_parts(keys, root)
        if not parts:
            return upsert_gold(found[0], root, then)
    if not is_kept(spark, root, "silver_tail"):
        found += [gold_for_changes(keys, root, parts)]
        return upsert_gold(reduce(DataFrame.unionByName, found), root, then)
    tail = read_buckets(spark, root, "silver_tail", {bucket for _, bucket in parts}).drop("bucket")
    counted = Observation()
    symbols = reach_of_tail(tail, keys).observe(
        counted, F.count_if("far").alias("far"), F.count(F.lit(1)).alias("all"))
    with staged(symbols, "changed-symbols") as reach:
        far, all_ = counted.get["far"], counted.get["all"]
        near, back = (keys.join(reach.where(F.col("far") == side), "symbol", "left_semi")
                      for side in (False, True))
        found += [gold_from_tail(tail, near)] if far < all_ else []
        if far:
            found += [gold_for_changes(back, root) if far < all_ else gold_for_changes(keys, root, parts)]
        return upsert_gold(reduce(DataFrame.unionByName, found), root, then)


def upsert_gold(features: DataFrame, root: str,
                then: Callable[[DataFrame], None] | None = None) -> int:
    """Merge rows into the buckets of gold they touch, and into the newest features; two rows for one
    key raise. ``then`` is called with the rows when they are merged."""
    spark = features.sparkSession
    with staged(features, "gold-changes") as rows:
        parts = _unique_parts(rows, root)
        follows = is_kept(spark, root, "gold_latest") or not table_exists(spark, root, "features_gold")
        known = read_parts(spark, root, "features_gold", parts)
        merged = merge_keyed(known.select(*GOLD.names), rows)
        count = write_months(enforce_constraints(merged, KEY), root, "features_gold")["rows"]
        if follows:
            latest = read_buckets(spark, root, "gold_latest", {bucket for _, bucket in parts}).drop("bucket")
            known = latest.select("symbol", F.col("dt").alias("_last"))
            news = rows.join(known, "symbol", "left").where(
                F.col("_last").isNull() | (F.col("dt") >= F.col("_last")))
            _follow(spark, root, "gold_latest", news, lambda: advance_latest(latest, rows))
        if then:
            then(rows)
        return count


def advance_latest(latest: DataFrame, rows: DataFrame) -> DataFrame:
    """The newest row of each symbol after a merge of ``rows``, which win at equal dates."""
    both = latest.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)))
    newest = F.row_number().over(Window.partitionBy("symbol").orderBy(F.desc("dt"), F.desc("_new")))
    return both.withColumn("_rank", newest).where(F.col("_rank") == 1).select(*GOLD.names)


def _unique_parts(rows: DataFrame, root: str) -> list[tuple[int, int]]:
    """The months and buckets that ``rows`` fall in; a repeated key raises. One pass does both."""
    count = buckets(rows.sparkSession, root)
    parts = rows.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).groupBy(
        month_key(F.col("dt")).alias("ym"), bucket_of(F.col("symbol"), count).alias("bucket")).agg(
        F.max_by(F.struct(*KEY, "n"), "n").alias("most")).collect()
    for row in parts:
        if row["most"]["n"] > 1:
            raise DuplicateKeyError(f"key occurs {row['most']['n']} times: "
                                    f"{[row['most'][key] for key in KEY]}")
    return sorted((row["ym"], row["bucket"]) for row in parts if row["ym"] is not None)


def gold_for_changes(changes: DataFrame, root: str, parts: Parts | None = None,
                     margin: int = 2) -> DataFrame | None:
    """Features of each changed row and of the next ``HALO`` rows of its symbol.

    Reads the months of the changes and ``margin`` months on either side, in the buckets of the
    changed symbols and in one scan. A correction years back is a segment of its own, so the months
    between it and today are not read; windows run by symbol and segment.
    """
    spark = changes.sparkSession
    parts = touched_parts(changes, root) if parts is None else parts
    if not parts:
        return None
    buckets = sorted({bucket for _, bucket in parts})
    segments = month_segments(sorted({month for month, _ in parts}), margin)
    stored = stored_months(spark, root, "price_silver")
    number = {month: i for i, (low, high) in enumerate(segments)
              for month in stored if low <= month <= high}

    def silver(months):
        return read_months(spark, root, "price_silver", months, buckets).select(
            *KEY, "close", "volume", "ym")

    of_month = F.create_map(*[F.lit(x) for pair in number.items() for x in pair])
    place = ["symbol", "_segment"]
    marks = changes.select(*KEY).distinct().withColumn("_changed", F.lit(1))
    span = marks.groupBy("symbol", of_month[month_key(F.col("dt"))].alias("_segment")).agg(
        F.min("dt").alias("_first"), F.max("dt").alias("_last"))
    # Cut to the changed symbols before anything else.
    bars = silver(number).withColumn("_segment", of_month[F.col("ym")]).join(span, place)
    wanted = [*place, "dt", "close", "volume", "_changed"]
    rows = bars.join(marks, KEY, "left").select(*wanted)

    # Symbols too sparse to have HALO rows before their first and after their last change in these
    # months get the nearest HALO rows from the months outside.
    sparse = bars.groupBy(*place).agg(
        F.count_if(F.col("dt") < F.col("_first")).alias("_before"),
        F.count_if(F.col("dt") > F.col("_last")).alias("_after")
    ).where(F.least("_before", "_after") < HALO)
    elsewhere = len(segments) > 1 or len(stored) > len(number)
    if elsewhere and not sparse.isEmpty():
        ends = [F.create_map(*[F.lit(x) for i, pair in enumerate(segments) for x in (i, pair[end])])
                for end in (0, 1)]
        earlier = (F.col("ym") < ends[0][F.col("_segment")]) & (F.col("_before") < HALO)
        later = (F.col("ym") > ends[1][F.col("_segment")]) & (F.col("_after") < HALO)
        day = F.unix_date("dt")
        rank = F.row_number().over(Window.partitionBy(*place, "_early").orderBy(
            F.when(F.col("_early"), -day).otherwise(day)))
        outside = silver(stored).join(sparse, "symbol").where(earlier | later).withColumn(
            "_early", F.col("ym") < ends[0][F.col("_segment")])
        # They are read by frames only: if changed themselves, they are so in their own segment.
        rows = rows.unionByName(outside.withColumn("_rank", rank).where(F.col("_rank") <= HALO)
                                .withColumn("_changed", F.lit(None).cast("int")).select(*wanted))

    frame = Window.partitionBy(*place).orderBy("dt").rowsBetween(-HALO, Window.currentRow)
    near = rows.withColumn("_near", F.max("_changed").over(frame))
    found = gold_features(near, carry=["_near"], series=place).where(F.col("_near") == 1).select(
        *GOLD.names)
    # A sparse symbol can have the same row in reach of two segments, with the same values.
    return found.distinct() if len(segments) > 1 else found


def month_segments(months: list[int], margin: int) -> list[tuple[int, int]]:
    """Ranges that hold ``months`` and ``margin`` months around each; ranges that meet are one."""
    segments: list[list[int]] = []
    for index in sorted(month // 100 * 12 + month % 100 - 1 for month in months):
        if segments and index - margin <= segments[-1][1] + 1:
            segments[-1][1] = index + margin
        else:
            segments.append([index - margin, index + margin])
    return [tuple(index // 12 * 100 + index % 12 + 1 for index in pair) for pair in segments]


def refresh_price_sketches(spark: SparkSession, root: str,
                           parts: list[tuple[int, int]] | None = None) -> None:
    """Make the sketches of closes anew: of all of silver, or of the given (month, bucket) parts only."""
    silver = (read_table(spark, root, "price_silver") if parts is None
              else read_parts(spark, root, "price_silver", parts))
    rows = price_sketches(silver).withColumn("bucket", bucket_of(F.col("symbol"), buckets(spark, root)))
    rows.hint("rebalance", "ym").write.mode("overwrite").option(
        "partitionOverwriteMode", "static" if parts is None else "dynamic").partitionBy(
        "ym", "bucket").parquet(table_path(root, "price_sketches"))


def refresh_key_sketches(spark: SparkSession, root: str, loads: list[tuple[str, int]]) -> None:
    """Make the key sketches of the given loads, which are the only rows read."""
    key_sketches(read_bronze_loads(spark, root, loads)).coalesce(1).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic").partitionBy("source", "batch").parquet(
        table_path(root, "key_sketches"))


def read_price_sketches(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("symbol string, n_rows long, sketch binary, ym int, bucket int").parquet(
        table_path(root, "price_sketches"))


def read_key_sketches(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("ym int, n_rows long, sketch binary, source string, batch long").parquet(
        table_path(root, "key_sketches"))
