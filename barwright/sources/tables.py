"""The stored tables: Parquet below one root folder.

Bronze has a folder per load (source, batch); silver and gold a folder per month and bucket of
symbols, so that the files of a month hold disjoint symbols and a correction of one symbol rewrites
one bucket. Two small tables go with them, a folder per bucket: ``silver_tail``, the last rows of each
symbol, and ``gold_latest``, its newest features. The number of buckets is chosen at the first load, by
its size or ``spark.barwright.buckets``, and kept with the tables; :func:`rebucket` changes it. Writes replace whole folders
through Spark's commit protocol: a job that fails, or loses executors, leaves the table as it was;
only a driver lost during the commit itself can leave some folders new and others not, which repeating
the refresh mends. Numbers of loads, layout and versions are in the state (:mod:`.state`).
"""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterable, Iterator
from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.functions.dates import month_key
from barwright.operators.serving import latest_features
from barwright.schemas import (
    BAR_COLUMNS, GOLD, KEY, STORED, check_compatible, empty_table, few_rows,
)
from barwright.session import path_exists, remove, rename, subfolders
from barwright.sources.state import as_ranges, change_state, in_ranges, read_state, without


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def table_exists(spark: SparkSession, root: str, name: str) -> bool:
    return path_exists(spark, table_path(root, name))


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The stored table with its declared schema; an empty one when nothing was written yet."""
    if not table_exists(spark, root, name):
        return empty_table(spark, name)
    if name == BRONZE_TABLE:
        return _bronze_rows(spark, root, [table_path(root, name)], _shown(read_state(spark, root)))
    return spark.read.schema(STORED[name]).parquet(table_path(root, name))


BRONZE_TABLE = "bronze_price_raw"
# In gathered files: the load that a row came with.
GATHERED_LOAD = "load_batch"


def _bronze_rows(spark: SparkSession, root: str, paths: list[str], shown: Column) -> DataFrame:
    """Rows of bronze folders that ``shown`` lets through; ``batch`` is that of the row's load."""
    declared = STORED[BRONZE_TABLE]
    schema = T.StructType([*declared.fields, T.StructField(GATHERED_LOAD, T.LongType())])
    rows = spark.read.schema(schema).option("basePath", table_path(root, BRONZE_TABLE)).parquet(*paths)
    return rows.where(shown).withColumn("batch", F.coalesce(GATHERED_LOAD, "batch")).select(
        *declared.names)


def _within(column: str, ranges: list[list[int]]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(column).between(*r) for r in ranges], F.lit(False))


def _shown(state: dict) -> Column:
    """What counts of bronze: the folders of loads, but for those that were gathered, and of gathered
    folders the rows whose loads are gathered there and were not replaced since."""
    own, gathered = F.col("batch") >= 0, F.lit(False)
    for source, entry in state.get("sources", {}).items():
        here = F.col("source") == source
        for part in entry.get("gathered", []):
            own &= ~(here & _within("batch", part["loads"]))
            gathered |= here & (F.col("batch") == part["folder"]) & _within(GATHERED_LOAD, part["loads"])
    return own | gathered


def _gathered_in(state: dict, source: str, batch: int) -> dict | None:
    for part in state.get("sources", {}).get(source, {}).get("gathered", []):
        if in_ranges(batch, part["loads"]):
            return part
    return None


def read_bronze_loads(spark: SparkSession, root: str, loads: list[tuple[str, int]]) -> DataFrame:
    """The given (source, batch) loads. Their folders are opened by name, so the files of other
    loads are not even listed."""
    state, folders = read_state(spark, root), {}
    for source, batch in loads:
        part = _gathered_in(state, source, batch)
        folders.setdefault((source, part["folder"] if part else batch), []).append(batch)
    paths = [load_path(root, BRONZE_TABLE, source, folder) for source, folder in folders]
    shown = F.col("batch") >= 0
    for (source, folder), batches in folders.items():
        if folder < 0:
            shown |= (F.col("source") == source) & (F.col("batch") == folder) & F.col(
                GATHERED_LOAD).isin(batches)
    return _bronze_rows(spark, root, sorted(paths), shown)


def append_bronze(bars: DataFrame, root: str, source: str, batch: int) -> int:
    """Add a load and return its number of rows. Loading the same input again adds it again."""
    spark = bars.sparkSession
    if _gathered_in(read_state(spark, root), source, batch):
        # Its rows go back into a folder of their own first.
        path = load_path(root, BRONZE_TABLE, source, batch)
        read_bronze_loads(spark, root, [(source, batch)]).drop("source", "batch").write.mode(
            "overwrite").parquet(path)
        _take_out(spark, root, source, batch)
    return _write_bronze(bars, root, source, batch, "append")


def replace_bronze_batch(bars: DataFrame, root: str, source: str, batch: int) -> int:
    """Write a load so that repeating it, as a restarted stream does, leaves one copy. Of a load that
    was gathered the rows of before no longer count."""
    rows = _write_bronze(bars, root, source, batch, "overwrite")
    _take_out(bars.sparkSession, root, source, batch)
    return rows


def _take_out(spark: SparkSession, root: str, source: str, batch: int) -> None:
    def change(state):
        part = _gathered_in(state, source, batch)
        if part:
            part["loads"] = without(part["loads"], batch)
    change_state(spark, root, change)


def load_path(root: str, name: str, source: str, batch: int) -> str:
    if not re.fullmatch(r"[\w.-]+", source):
        raise ValueError(f"a source name is used as a folder name, which rules out {source!r}")
    return f"{table_path(root, name)}/source={source}/batch={batch}"


def _write_bronze(bars: DataFrame, root: str, source: str, batch: int, mode: str) -> int:
    """Write into the folder of the load itself: ``partitionBy`` would sort every task first, by
    columns that are constant."""
    counted = Observation()
    (bars.drop("source")
     .observe(counted, F.count(F.lit(1)).alias("rows"))
     .write.mode(mode)
     .parquet(load_path(root, "bronze_price_raw", source, batch)))
    renew_views(bars.sparkSession, root)
    return counted.get["rows"]


# Gathered folders of a source; one more and all become one.
MOST_GATHERED = 8


def compact_bronze(spark: SparkSession, root: str, source: str) -> int:
    """Gather the worked-in loads of ``source`` in one folder and return how many; a stream leaves a
    folder for each micro-batch.

    The newest stays, since a restarted stream may write it again; so do loads that are being written
    or wait for a refresh. Gathered rows keep the number of their load, so that it can still be
    replaced. The new folder counts from the moment the state names it, and the old ones no longer:
    a job lost before leaves a folder that nobody reads, one lost after leaves such folders too, and
    the next call removes them.
    """
    state = read_state(spark, root)
    entry = state.get("sources", {}).get(source, {})
    parts = entry.get("gathered", [])
    there = [int(f.removeprefix("batch=")) for f in subfolders(
        spark, f"{table_path(root, BRONZE_TABLE)}/source={source}") if f.startswith("batch=")]
    current = {part["folder"] for part in parts}
    gone = [b for b in there if (b < 0 and b not in current)
            or (b >= 0 and any(in_ranges(b, part["loads"]) for part in parts))]
    for batch in gone:
        remove(spark, load_path(root, BRONZE_TABLE, source, batch))
    busy = {batch for _, batch in entry.get("open", []) + entry.get("started", [])}
    newest = entry.get("high", [0, -1])[1]
    old = sorted(b for b in there if 0 <= b < newest and b not in busy and b not in gone)
    if not old:
        return 0
    merged = parts if len(parts) >= MOST_GATHERED else []
    loads = as_ranges([*old, *(n for part in merged for low, high in part["loads"]
                               for n in range(low, high + 1))])
    folder = min([0, *current, *there]) - 1
    read = [(source, n) for low, high in loads for n in range(low, high + 1)]
    read_bronze_loads(spark, root, read).withColumn(GATHERED_LOAD, F.col("batch")).drop(
        "source", "batch").hint("rebalance").write.mode("overwrite").parquet(
        load_path(root, BRONZE_TABLE, source, folder))

    def change(now):
        known = now["sources"][source]
        if known.get("gathered", []) != parts:
            raise RuntimeError(f"loads of {source} were gathered or replaced meanwhile")
        known["gathered"] = [p for p in parts if p not in merged] + [{"folder": folder, "loads": loads}]
    change_state(spark, root, change)
    for batch in [*old, *(part["folder"] for part in merged)]:
        remove(spark, load_path(root, BRONZE_TABLE, source, batch))
    renew_views(spark, root)
    return len(old)


# A bucket of a month should have about so many bytes; a row takes about so many.
BUCKET_BYTES, ROW_BYTES = 256 << 20, 64


def buckets(spark: SparkSession, root: str) -> int:
    """The number of buckets of the tables below ``root``, settled by the first call."""
    return read_state(spark, root).get("buckets") or settle_buckets(spark, root)


def settle_buckets(spark: SparkSession, root: str, rows_of_month: float = 0) -> int:
    """Settle the number of buckets, if it is not: ``spark.barwright.buckets``, or what the size of a
    month asks for. :func:`rebucket` changes it."""
    asked = spark.conf.get("spark.barwright.buckets", None)
    count = int(asked) if asked else max(1, ceil(rows_of_month * ROW_BYTES / BUCKET_BYTES))
    return change_state(spark, root, lambda state: state.setdefault("buckets", count))


MOVED = "_moved"


def rebucket(spark: SparkSession, root: str, count: int) -> None:
    """Give the tables below ``root`` another number of buckets. Nobody else may write meanwhile.

    All tables are written anew beside the old ones first. From the moment the state names the new
    number they take their places, one folder after the other; a driver lost in between leaves that
    to :func:`finish_move`, which the next call of this function or of a refresh makes.
    """
    finish_move(spark, root)
    if count == buckets(spark, root):
        return
    moved = f"{root.rstrip('/')}/{MOVED}"
    remove(spark, moved)
    names = [name for name, schema in STORED.items() if "bucket" in schema.names
             and table_exists(spark, root, name)]
    for name in names:
        months = [part for part in ("ym", "bucket") if part in STORED[name].names]
        read_table(spark, root, name).withColumn("bucket", bucket_of(F.col("symbol"), count)).hint(
            "rebalance", *months).sortWithinPartitions(*months, *KEY).write.partitionBy(*months).parquet(
            f"{moved}/{name}")
    change_state(spark, root, lambda state: state.update(buckets=count, moving=names))
    finish_move(spark, root)


def finish_move(spark: SparkSession, root: str) -> None:
    """Put tables that :func:`rebucket` wrote in their places."""
    for name in read_state(spark, root).get("moving", []):
        new = f"{root.rstrip('/')}/{MOVED}/{name}"
        if path_exists(spark, new):  # else it is in its place already
            remove(spark, table_path(root, name))
            rename(spark, new, table_path(root, name))
        elif not table_exists(spark, root, name):
            raise FileNotFoundError(f"{name} was lost while its buckets changed")
    change_state(spark, root, lambda state: state.pop("moving", None))
    renew_views(spark, root)


def bucket_of(symbol: Column, count: int) -> Column:
    return F.pmod(F.xxhash64(symbol), F.lit(count)).cast("int")


LOADS = "number long, source string, batch long, state string"


def loads(spark: SparkSession, root: str) -> DataFrame:
    """Of each source the loads that wait for a refresh (``loaded``) or are being written (``started``),
    and the newest of those worked into silver and gold (``applied``)."""
    rows = []
    for source, entry in read_state(spark, root).get("sources", {}).items():
        rows += [(n, source, b, "started") for n, b in entry.get("started", [])]
        rows += [(n, source, b, "loaded") for n, b in entry.get("open", [])]
        rows += [(*entry["high"][:1], source, entry["high"][1], "applied")] if "high" in entry else []
    return few_rows(spark, rows, LOADS)


def note_loads(spark: SparkSession, root: str, noted: list[tuple[int, str, int]],
               state: str) -> None:
    """Keep that loads (number, source, batch) are ``started``, ``loaded`` or ``applied``."""
    def change(now):
        for number, source, batch in noted:
            entry = now.setdefault("sources", {}).setdefault(source, {})
            now["number"] = max(now.get("number", 0), number)
            for name in ("started", "open"):
                entry[name] = [x for x in entry.get(name, []) if x[1] != batch]
            if state == "applied":
                if batch >= entry.get("high", [0, batch])[1]:
                    entry["high"] = [number, batch]
            else:
                name = "open" if state == "loaded" else "started"
                entry[name] = sorted([*entry[name], [number, batch]])
    if noted:
        change_state(spark, root, change)


def load_number(spark: SparkSession, root: str, source: str | None = None,
                batch: int | None = None, count: int = 1) -> int:
    """The next number over all sources, which nobody else gets, and ``count - 1`` after it; the number
    it has already for a load that is repeated."""
    def change(state):
        entry = state.get("sources", {}).get(source, {})
        known = [*entry.get("started", []), *entry.get("open", []), entry.get("high", [0, None])]
        own = [number for number, its in known if its == batch]
        if source is not None and own:
            return own[0]
        first = state.get("number", 0) + 1
        state["number"] = first + count - 1
        return first
    return change_state(spark, root, change)


def pending_loads(spark: SparkSession, root: str) -> list[tuple[int, str, int]]:
    """Loads that no refresh has worked in yet: (number, source, batch)."""
    sources = read_state(spark, root).get("sources", {})
    return sorted((number, source, batch) for source, entry in sources.items()
                  for number, batch in entry.get("open", []))


def touched_parts(rows: DataFrame, root: str) -> list[tuple[int, int]]:
    """The months and buckets ``rows`` falls in: no more than the tables have folders for."""
    count = buckets(rows.sparkSession, root)
    parts = rows.select(month_key(F.col("dt")).alias("ym"),
                        bucket_of(F.col("symbol"), count).alias("bucket")).distinct()
    return sorted((row["ym"], row["bucket"]) for row in parts.collect())


def stored_months(spark: SparkSession, root: str, name: str) -> list[int]:
    folders = subfolders(spark, table_path(root, name))
    return sorted(int(f.removeprefix("ym=")) for f in folders if f.startswith("ym="))


def read_months(spark: SparkSession, root: str, name: str, months: Iterable[int],
                only: Iterable[int] | None = None) -> DataFrame:
    """Only the given months of a table, and of those only the given buckets."""
    parts = [(month, bucket) for month in months for bucket in
             (range(buckets(spark, root)) if only is None else only)]
    return read_parts(spark, root, name, parts)


def _stored_parts(spark: SparkSession, root: str, name: str,
                  parts: Iterable[tuple[int, int]]) -> list[str]:
    path, wanted, parts = table_path(root, name), [], set(parts)
    for month in {month for month, _ in parts} & set(stored_months(spark, root, name)):
        there = subfolders(spark, f"{path}/ym={month}")
        wanted += [f"{path}/ym={month}/{folder}" for folder in there
                   if folder.startswith("bucket=")
                   and (month, int(folder.removeprefix("bucket="))) in parts]
    return wanted


def any_stored(spark: SparkSession, root: str, name: str, parts: Iterable[tuple[int, int]]) -> bool:
    """Whether a table has one of the given (month, bucket) folders."""
    return bool(_stored_parts(spark, root, name, parts))


def read_parts(spark: SparkSession, root: str, name: str,
               parts: Iterable[tuple[int, int]]) -> DataFrame:
    """Only the given (month, bucket) folders of a table. They are opened by name, so the files of
    others are not even listed."""
    path, wanted = table_path(root, name), _stored_parts(spark, root, name, parts)
    if not wanted:
        return empty_table(spark, name)
    return spark.read.schema(STORED[name]).option("basePath", path).parquet(*sorted(wanted))


def check_schemas(spark: SparkSession, root: str) -> dict[str, int]:
    """Table name -> version of its schema. The versions are kept with the tables: a declared schema
    that only adds columns to the last one becomes the next version, any other change raises."""
    known = read_state(spark, root).get("schemas", {})
    new = {}
    for name, declared in STORED.items():
        version, columns = known.get(name, (0, None))
        if columns is None:
            check_stored_schema(spark, root, name)
        elif columns == declared.json():
            continue
        else:
            check_compatible(columns, declared)
        new[name] = [version + 1, declared.json()]
    if new:
        change_state(spark, root, lambda state: state.setdefault("schemas", {}).update(new))
    return {name: version for name, (version, _) in {**known, **new}.items()}


def check_stored_schema(spark: SparkSession, root: str, name: str) -> None:
    """Raise when the files of a table, of which no version is known, were written with a schema
    that the declared one cannot follow. Reads one file footer."""
    folders = ("ym", "bucket", "source", "batch", GATHERED_LOAD)
    if not any(f.startswith(folders) for f in subfolders(spark, table_path(root, name))):
        return
    written = spark.read.parquet(table_path(root, name)).schema
    old, new = ([f for f in schema.fields if f.name not in folders]
                for schema in (written, STORED[name]))
    check_compatible(T.StructType(old), T.StructType(new))


def write_months(rows: DataFrame, root: str, name: str, metrics: list[Column] | None = None,
                 follows: bool = False) -> dict[str, int]:
    """Replace the months and buckets that occur in ``rows`` and leave all others alone. The table that
    follows this one counts as out of date, unless the caller sees to it (``follows``).

    ``rebalance`` gathers a bucket into few files, and AQE splits one that is larger than the
    advisory partition size, so neither thousands of small files nor one huge task appear. The
    overwrite mode is set on the write itself: with the session default (static) Spark would empty
    the whole table first.
    """
    counted, spark = Observation(), rows.sparkSession
    count = buckets(spark, root)
    if not follows and is_kept(spark, root, FOLLOWERS[name]):
        keep(spark, root, FOLLOWERS[name], False)
    (rows.withColumn("ym", month_key(F.col("dt")))
     .withColumn("bucket", bucket_of(F.col("symbol"), count))
     .select(STORED[name].names)
     .hint("rebalance", "ym", "bucket")
     .sortWithinPartitions("ym", "bucket", *KEY)
     .observe(counted, *(metrics or [F.count(F.lit(1)).alias("rows")]))
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("ym", "bucket")
     .parquet(table_path(root, name)))
    renew_views(spark, root)
    return counted.get


# Tables that follow silver and gold: kept up to date by the writes that know the changed rows, and
# not to be read after any other write until a full refresh makes them anew.
FOLLOWERS = {"price_silver": "silver_tail", "features_gold": "gold_latest"}


def is_kept(spark: SparkSession, root: str, name: str) -> bool:
    return read_state(spark, root).get("kept", {}).get(name, False)


def keep(spark: SparkSession, root: str, name: str, kept: bool = True) -> None:
    change_state(spark, root, lambda state: state.setdefault("kept", {}).update({name: kept}))


def write_buckets(rows: DataFrame, root: str, name: str) -> None:
    """Replace the buckets that occur in ``rows`` of a table that has no months."""
    count = buckets(rows.sparkSession, root)
    (rows.withColumn("bucket", bucket_of(F.col("symbol"), count))
     .select(STORED[name].names)
     .hint("rebalance", "bucket")
     .write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("bucket")
     .parquet(table_path(root, name)))


def read_buckets(spark: SparkSession, root: str, name: str, only: Iterable[int]) -> DataFrame:
    """Only the given buckets of a table that has no months."""
    path = table_path(root, name)
    there = {int(f.removeprefix("bucket=")) for f in subfolders(spark, path) if f.startswith("bucket=")}
    wanted = [f"{path}/bucket={b}" for b in sorted(there & {*only})]
    if not wanted:
        return empty_table(spark, name)
    return spark.read.schema(STORED[name]).option("basePath", path).parquet(*wanted)


_VIEWS = "spark.barwright.views"
_LATER = "spark.barwright.viewsLater"


@contextlib.contextmanager
def views_at_the_end(spark: SparkSession) -> Iterator[None]:
    """Views are renewed once, after all writes inside."""
    if spark.conf.get(_LATER, None):
        yield
        return
    spark.conf.set(_LATER, "yes")
    try:
        yield
    finally:
        spark.conf.unset(_LATER)
        root = spark.conf.get(_VIEWS, None)
        if root:
            register_views(spark, root)


def renew_views(spark: SparkSession, root: str) -> None:
    """Point the session's views, if they show the tables below ``root``, to the files of now. A
    view keeps the list of files of its making, and writes replace files."""
    if spark.conf.get(_VIEWS, None) == root and not spark.conf.get(_LATER, None):
        register_views(spark, root)


def latest_rows(spark: SparkSession, root: str) -> DataFrame:
    """The newest features of each symbol: the kept table, or from gold where none is kept."""
    if is_kept(spark, root, "gold_latest"):
        return read_table(spark, root, "gold_latest").select(*GOLD.names)
    return latest_features(read_table(spark, root, "features_gold").select(*GOLD.names))


def register_views(spark: SparkSession, root: str) -> None:
    """Temporary views with the public columns: the three tables and ``latest_features``. Writes of
    this session renew them; after writes of others call this again."""
    spark.conf.set(_VIEWS, root)
    for name in ["bronze_price_raw", "price_silver"]:
        read_table(spark, root, name).select(*BAR_COLUMNS).createOrReplaceTempView(name)
    read_table(spark, root, "features_gold").select(*GOLD.names).createOrReplaceTempView("features_gold")
    latest_rows(spark, root).createOrReplaceTempView("latest_features")
