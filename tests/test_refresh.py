"""Stored tables: merges, repeated runs, and increments that must equal a full refresh."""

from __future__ import annotations

import datetime
import random
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barwright.operators.gold import gold_features
from barwright.operators.merge import DuplicateKeyError, merge_keyed, require_unique
from barwright.operators.quality import QualityError, enforce_constraints, require_constraints
from barwright.operators.silver import build_silver
from barwright.plans import refresh
from barwright.schemas import GOLD, SILVER, SchemaChangeError
from barwright.session import scratch_dir, staged
from barwright.sources import tables
from barwright.sources.raw import EmptySourceError, RawBars
from bars_help import bar, day, price, rows_of
from test_silver_gold import random_series


def silver_of(spark, root):
    return rows_of(tables.read_table(spark, root, "price_silver").select(*SILVER.names))


def gold_of(spark, root):
    return rows_of(tables.read_table(spark, root, "features_gold").select(*GOLD.names))


def expected(bronze_rows):
    silver = build_silver(bronze_rows)
    return rows_of(silver.select(*SILVER.names)), rows_of(gold_features(silver))


def months(root):
    return {p.name: sorted(f.name for f in p.glob("bucket=*/*.parquet"))
            for p in Path(root, "price_silver").glob("ym=*")}


def test_running_twice_changes_bronze_only(spark, bronze, tmp_path):
    root = str(tmp_path)
    rows = bronze(random_series(random.Random(3), "A", 50, 120))
    for batch in (1, 2):
        tables.append_bronze(rows, root, "t", batch)
        result = refresh.refresh_all(spark, root)
    assert tables.read_table(spark, root, "bronze_price_raw").count() == 100
    assert (result.silver_rows, result.gold_rows) == (50, 50)
    assert (silver_of(spark, root), gold_of(spark, root)) == expected(rows)


def test_merge_inserts_overwrites_with_nulls_and_never_deletes(spark):
    schema = "symbol string, dt date, ret1d double"
    base = spark.createDataFrame([("A", day("2024-01-02"), 1.0), ("B", day("2024-01-02"), 2.0)],
                                 schema)
    inc = spark.createDataFrame([("B", day("2024-01-02"), None), ("C", day("2024-01-02"), 3.0)],
                                schema)
    assert rows_of(merge_keyed(base, inc), "symbol", "ret1d") == [
        ("A", 1.0), ("B", None), ("C", 3.0)]


def test_an_increment_with_a_repeated_key_is_refused(bronze):
    rows = bronze([bar("A", "2024-01-02", 1), bar("A", "2024-01-02", 2)])
    with pytest.raises(DuplicateKeyError):
        require_unique(rows)
    require_unique(build_silver(rows))


def test_silver_rows_gone_from_bronze_survive_and_old_loads_do_not_win(spark, bronze, tmp_path):
    root = str(tmp_path)
    with staged(build_silver(bronze([bar("A", "2024-01-02", 10, seq=9)])), "x") as rows:
        refresh.apply_to_silver(rows, root)
    with staged(build_silver(bronze([bar("A", "2024-01-02", 1, seq=2),
                                     bar("B", "2024-01-02", 1, seq=2)])), "x") as rows:
        refresh.apply_to_silver(rows, root)
        once = silver_of(spark, root)
        refresh.apply_to_silver(rows, root)
    assert silver_of(spark, root) == once
    assert [(row[0], row[5], row[7]) for row in once] == [
        ("A", price(10), 9), ("B", price(1), 2)]
    tables.append_bronze(bronze([bar("C", "2024-01-02", 1)]), root, "t", 1)
    refresh.refresh_silver(spark, root)
    assert [row[0] for row in silver_of(spark, root)] == ["A", "B", "C"]


def test_an_upsert_rewrites_only_the_months_it_touches(spark, bronze, tmp_path):
    root = str(tmp_path)
    tables.append_bronze(bronze([bar("A", f"2024-{m:02}-05", m) for m in range(1, 7)]), root,
                         "t", 1)
    refresh.refresh_all(spark, root)
    before = months(root)
    tables.append_bronze(bronze([bar("A", "2024-03-06", 3)]), root, "t", 2)
    refresh.refresh_increment(spark, root, [("t", 2)])
    after = months(root)
    assert [m for m in before if before[m] != after[m]] == ["ym=202403"]
    assert len(silver_of(spark, root)) == 7


@pytest.mark.parametrize("seed", range(4))
def test_increments_equal_a_full_refresh(spark, bronze, tmp_path, seed):
    """Late rows, corrections and new symbols, on dense and on very sparse series."""
    rng = random.Random(seed)
    root = str(tmp_path)
    series = {"DENSE": random_series(rng, "DENSE", 300, 320),
              "SPARSE": random_series(rng, "SPARSE", 60, 4000),
              "TINY": random_series(rng, "TINY", 5, 4000),
              "NEW": random_series(rng, "NEW", 30, 60)}
    everything = [row for rows in series.values() for row in rows]
    late = [row for row in everything if row[0] == "NEW" or rng.random() < 0.05]
    early = [row for row in everything if row not in late]
    fixes = [(*row[:5], price(rng.randrange(1, 99)), row[6], "t", 5)
             for row in rng.sample(early, 4)]
    loads = [early, late, fixes]
    for batch, rows in enumerate(loads):
        tables.append_bronze(bronze(rows), root, "t", batch)
        if batch == 0:
            refresh.refresh_all(spark, root)
        else:
            refresh.refresh_increment(spark, root, [("t", batch)])
    assert (silver_of(spark, root), gold_of(spark, root)) == expected(bronze(sum(loads, [])))


def test_sparse_symbols_find_their_rows_outside(spark, bronze, tmp_path):
    root = str(tmp_path)
    rng = random.Random(9)
    rows = [row for s in "ABCD" for row in random_series(rng, s, 12, 900)]
    fixes = [(*row[:5], price(3), row[6], "t", 5) for row in rows[::12]]
    for batch, load in enumerate([rows, fixes]):
        tables.append_bronze(bronze(load), root, "t", batch)
    refresh.refresh_increment(spark, root, [("t", 0)])
    refresh.refresh_increment(spark, root, [("t", 1)])
    assert (silver_of(spark, root), gold_of(spark, root)) == expected(bronze(rows + fixes))


@pytest.mark.parametrize("months, expected", [
    ([], []),
    ([202401], [(202311, 202403)]),
    ([202401, 202406], [(202311, 202408)]),
    ([202401, 202407], [(202311, 202403), (202405, 202409)]),
    ([202401, 202402, 199912], [(199910, 200002), (202311, 202404)]),
    ([200001, 200101, 200201, 201001, 202001],
     [(199911, 200003), (200011, 200103), (200111, 200203), (200911, 201003), (201911, 202003)]),
])
def test_month_segments(months, expected):
    assert refresh.month_segments(months, 2) == expected


def test_an_old_correction_does_not_read_the_months_since(spark, bronze, tmp_path):
    root = str(tmp_path)
    first = datetime.date(2015, 1, 1)
    rows = [bar("A", (first + datetime.timedelta(days=d)).isoformat(), d % 7 + 1)
            for d in range(0, 2000, 1)]
    fixes = [bar("A", "2015-06-10", 99, seq=2), bar("A", "2019-02-01", 98, seq=2)]
    tables.append_bronze(bronze(rows), root, "t", 1)
    refresh.refresh_all(spark, root)
    tables.append_bronze(bronze(fixes), root, "t", 2)
    result = refresh.refresh_increment(spark, root, [("t", 2)])
    assert (silver_of(spark, root), gold_of(spark, root)) == expected(bronze(rows + fixes))
    # Two touched months of silver, and of gold the two and the months after them.
    assert (result.silver_rows, result.gold_rows) == (30 + 28, 30 + 28)
    affected = refresh.gold_for_changes(build_silver(bronze(fixes)), root)
    assert affected.count() == 2 * 20
    read = {Path(f).parent.parent.name for f in affected.inputFiles()}
    assert "ym=201704" not in read and "ym=201508" in read


def test_ten_corrections_far_apart_read_their_months_only(spark, bronze, tmp_path):
    root = str(tmp_path)
    first = datetime.date(2005, 1, 1)
    rows = [bar("A", (first + datetime.timedelta(days=d)).isoformat(), d % 7 + 1)
            for d in range(0, 3650)]
    fixes = [bar("A", f"{2005 + n}-06-15", 50 + n, seq=2) for n in range(10)]
    for batch, load in enumerate([rows, fixes], 1):
        tables.append_bronze(bronze(load), root, "t", batch)
        if batch == 1:
            refresh.refresh_all(spark, root)
    affected = refresh.gold_for_changes(build_silver(bronze(fixes)), root)
    read = {Path(f).parent.parent.name for f in affected.inputFiles()}
    assert read == {f"ym={2005 + n}{m:02}" for n in range(10) for m in range(4, 9)}
    refresh.refresh_increment(spark, root, [("t", 2)])
    assert (silver_of(spark, root), gold_of(spark, root)) == expected(bronze(rows + fixes))


def test_a_correction_of_one_symbol_rewrites_one_bucket(spark, bronze, tmp_path):
    root = str(tmp_path)
    tables.change_state(spark, root, lambda state: state.update(buckets=4))
    rows = [bar(f"S{n}", f"2024-03-{d:02}", d) for n in range(40) for d in range(4, 9)]
    tables.append_bronze(bronze(rows), root, "t", 1)
    refresh.refresh_all(spark, root)
    files = lambda: {str(f.relative_to(root)) for name in ("price_silver", "features_gold")
                     for f in Path(root, name).rglob("*.parquet")}
    symbols = [{r["symbol"] for r in spark.read.parquet(str(p)).collect()}
               for p in Path(root, "price_silver", "ym=202403").glob("bucket=*")]
    assert len(symbols) == 4 and sum(map(len, symbols)) == len(set().union(*symbols)) == 40
    before = files()
    tables.append_bronze(bronze([bar("S7", "2024-03-05", 99, seq=2)]), root, "t", 2)
    refresh.refresh_increment(spark, root, [("t", 2)])
    changed = {Path(f).parent for f in before ^ files()}
    assert len(changed) == 2 and len({p.name for p in changed}) == 1


def test_the_number_of_buckets_stays(spark, tmp_path):
    root = str(tmp_path)
    assert tables.buckets(spark, root) == 1
    spark.conf.set("spark.barwright.buckets", "9")
    try:
        assert tables.buckets(spark, root) == 1
        assert tables.buckets(spark, root + "/other") == 9
    finally:
        spark.conf.unset("spark.barwright.buckets")


def test_a_full_refresh_follows_bronze(spark, bronze, tmp_path):
    root = str(tmp_path)
    tables.append_bronze(bronze([bar("A", "2024-01-02", 10, seq=1), bar("B", "2024-01-02", 5)]),
                         root, "t", 1)
    tables.append_bronze(bronze([bar("A", "2024-01-02", 99, seq=2)]), root, "t", 2)
    refresh.refresh_all(spark, root)
    tables.replace_bronze_batch(bronze([]), root, "t", 2)
    refresh.refresh_all(spark, root)
    assert [(r[0], r[5]) for r in silver_of(spark, root)] == [("A", price(10)), ("B", price(5))]
    tables.replace_bronze_batch(bronze([bar("A", "2024-01-02", 9, seq=1)]), root, "t", 1)
    refresh.refresh_all(spark, root)
    assert [(r[0], r[5]) for r in silver_of(spark, root)] == [("A", price(9)), ("B", price(5))]


def test_an_incoming_row_wins_at_equal_seq(spark, bronze, tmp_path):
    root = str(tmp_path)
    for close in (10, 9):
        with staged(build_silver(bronze([bar("A", "2024-01-02", close)])), "x") as rows:
            refresh.apply_to_silver(rows, root)
    assert [r[5] for r in silver_of(spark, root)] == [price(9)]


def raw_of(bronze, source, rows):
    return RawBars(source, bronze(rows).selectExpr("*", "string(null) AS _raw",
                                                   "string(null) AS _reason"))


def test_loads_are_numbered_over_all_sources_and_found_when_pending(spark, bronze, tmp_path):
    root = str(tmp_path)
    refresh.load(raw_of(bronze, "x", [bar("A", "2024-01-02", 1)]), root)
    refresh.load(raw_of(bronze, "y", [bar("B", "2024-01-02", 1)]), root)
    assert tables.pending_loads(spark, root) == [(1, "x", 1), (2, "y", 2)]
    assert refresh.refresh_increment(spark, root).gold_rows == 2
    assert tables.pending_loads(spark, root) == []
    assert refresh.refresh_increment(spark, root) == refresh.Refresh()
    refresh.load(raw_of(bronze, "x", [bar("C", "2024-01-02", 1)]), root)
    assert tables.pending_loads(spark, root) == [(3, "x", 3)]
    refresh.refresh_all(spark, root)
    assert tables.pending_loads(spark, root) == [] and len(silver_of(spark, root)) == 3
    assert tables.load_number(spark, root, "y", 2) == 2


def test_views_live_through_refreshes(spark, bronze, tmp_path):
    root = str(tmp_path)
    tables.register_views(spark, root)
    counts = lambda: [spark.table(name).count() for name in
                      ("bronze_price_raw", "price_silver", "features_gold", "latest_features")]
    assert counts() == [0, 0, 0, 0]
    refresh.run(spark, [raw_of(bronze, "t", [bar("A", "2024-01-02", 1)])], root)
    assert counts() == [1, 1, 1, 1]
    # A month that is there and a new one.
    refresh.run(spark, [raw_of(bronze, "t", [bar("A", "2024-01-03", 2), bar("B", "2024-05-02", 1)])],
                root, full=False)
    assert counts() == [3, 3, 3, 2]


def test_a_refresh_counts_and_stores_what_it_sets_aside_and_may_stop(spark, bronze, tmp_path):
    root = str(tmp_path)
    rows = [bar("A", f"2024-01-{d:02}", 5) for d in range(2, 10)]
    rows += [bar(None, "2024-01-02", 1), bar("A", "2024-01-10", 5, high=1)]
    tables.append_bronze(bronze(rows), root, "t", 1)
    with pytest.raises(QualityError, match="ohlc_is_inconsistent"):
        refresh.refresh_all(spark, root, {"ohlc_is_inconsistent": 0.1, "incomplete": 0.5})
    assert silver_of(spark, root) == []
    result = refresh.refresh_all(spark, root, {"ohlc_is_inconsistent": 0.2, "incomplete": 0.5})
    assert result.quality["incomplete"] == 1 and result.silver_rows == 9
    assert spark.read.parquet(f"{root}/quarantine").count() == 1
    with pytest.raises(QualityError, match="incomplete"):
        refresh.refresh_all(spark, root, {"incomplete": 0.0})


def test_a_full_refresh_refuses_a_repeated_silver_key(spark, bronze, tmp_path):
    root = str(tmp_path)
    one = build_silver(bronze([bar("A", "2024-01-02", 1)]))
    tables.write_months(one.unionByName(one), root, "price_silver")
    with pytest.raises(PySparkException, match="key is repeated"):
        refresh.refresh_gold(spark, root)


def test_an_increment_of_two_sources(spark, bronze, tmp_path):
    root = str(tmp_path)
    rng = random.Random(8)
    parts = [random_series(rng, symbol, 40, 90) for symbol in ("A", "B", "A")]
    parts[2] = [(*row[:8], 2) for row in parts[2]]
    sources = [RawBars(name, bronze(rows).selectExpr("*", "string(null) AS _raw",
                                                     "string(null) AS _reason"))
               for name, rows in zip(["x", "y", "z"], parts)]
    refresh.run(spark, sources[:1], root, 1)
    refresh.run(spark, sources[1:], root, 2, full=False)
    assert (silver_of(spark, root), gold_of(spark, root)) == expected(bronze(sum(parts, [])))


def test_an_increment_without_usable_rows_changes_nothing(spark, bronze, tmp_path):
    root = str(tmp_path)
    tables.append_bronze(bronze([bar(None, "2024-01-02", 1)]), root, "t", 1)
    result = refresh.refresh_increment(spark, root, [("t", 1)])
    assert (result.silver_rows, result.gold_rows) == (0, 0)


def test_broken_constraints_stop_the_write_and_keep_the_table(spark, bronze, tmp_path):
    root = str(tmp_path)
    good = build_silver(bronze([bar("A", "2024-01-02", 1)]))
    tables.write_months(enforce_constraints(good), root, "price_silver")
    bad = good.withColumn("volume", F.lit(-1).cast("long"))
    with pytest.raises(PySparkException, match="constraint broken"):
        tables.write_months(enforce_constraints(bad), root, "price_silver")
    assert len(silver_of(spark, root)) == 1
    require_constraints(good)
    with pytest.raises(QualityError, match="volume_is_negative"):
        require_constraints(bad)
    with pytest.raises(QualityError, match="repeat"):
        require_constraints(good.unionByName(good))


def test_gold_orphans_survive_a_full_refresh(spark, bronze, tmp_path):
    root = str(tmp_path)
    tables.write_months(gold_features(build_silver(bronze([bar("GONE", "2024-01-02", 1)]))),
                        root, "features_gold")
    tables.append_bronze(bronze([bar("A", "2024-01-02", 1)]), root, "t", 1)
    refresh.refresh_all(spark, root)
    assert [row[0] for row in gold_of(spark, root)] == ["A", "GONE"]


def test_views_show_the_public_columns(spark, bronze, tmp_path):
    root = str(tmp_path)
    tables.append_bronze(bronze([bar("A", "2024-01-02", 1), bar("A", "2024-01-03", 2),
                                 bar("B", "2024-01-02", 3)]), root, "t", 1)
    refresh.refresh_all(spark, root)
    tables.register_views(spark, root)
    counts = [spark.sql(f"SELECT count(*) FROM {name}").first()[0]
              for name in ("bronze_price_raw", "price_silver", "features_gold")]
    assert counts == [3, 3, 3]
    assert rows_of(spark.sql("SELECT symbol, dt, ret1d FROM latest_features")) == [
        ("A", day("2024-01-03"), 1.0), ("B", day("2024-01-02"), None)]
    assert spark.table("price_silver").columns == [
        "symbol", "dt", "open", "high", "low", "close", "volume"]


def test_scratch_lies_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(shared)
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_scratch_goes_with_the_process(tmp_path):
    code = """
import sys
from barwright.session import build_session, scratch_dir
spark = build_session("scratch", "local[1]", **{"spark.checkpoint.dir": sys.argv[1]})
path = scratch_dir(spark, "x")
spark.range(3).write.parquet(path)
assert spark.read.parquet(path).count() == 3
if sys.argv[2] == "stop":
    spark.stop()
"""
    for how in ("stop", "leave"):
        folder = tmp_path / how
        subprocess.run([sys.executable, "-c", code, str(folder), how], check=True, timeout=120,
                       cwd=Path(__file__).resolve().parents[1])
        assert list((folder / "barwright").iterdir()) == []


def test_tables_written_with_another_schema_are_refused(spark, bronze, tmp_path):
    root = str(tmp_path)
    spark.sql("SELECT 'A' AS symbol, 1 AS dt, 202401 AS ym").write.partitionBy("ym") \
        .parquet(f"{root}/price_silver")
    tables.append_bronze(bronze([bar("A", "2024-01-02", 1)]), root, "t", 1)
    with pytest.raises(SchemaChangeError, match="dt changed"):
        refresh.refresh_all(spark, root)
    tables.check_stored_schema(spark, root, "bronze_price_raw")


def test_schema_versions_are_kept_and_grow(spark, bronze, tmp_path, monkeypatch):
    root = str(tmp_path)
    tables.append_bronze(bronze([bar("A", "2024-01-02", 1)]), root, "t", 1)
    refresh.refresh_all(spark, root)
    assert tables.check_schemas(spark, root) == dict.fromkeys(tables.STORED, 1)
    wider = T.StructType([*tables.STORED["features_gold"].fields,
                          T.StructField("ma50", T.DoubleType())])
    monkeypatch.setitem(tables.STORED, "features_gold", wider)
    for _ in range(2):
        assert tables.check_schemas(spark, root)["features_gold"] == 2
    assert tables.read_table(spark, root, "features_gold").first()["ma50"] is None
    monkeypatch.setitem(tables.STORED, "features_gold", T.StructType(wider.fields[1:]))
    with pytest.raises(SchemaChangeError, match="symbol was dropped"):
        refresh.refresh_increment(spark, root, [("t", 1)])


def test_a_refresh_without_usable_rows_can_be_repeated(spark, bronze, tmp_path):
    root = str(tmp_path)
    tables.append_bronze(bronze([bar(None, "2024-01-02", 1)]), root, "t", 1)
    for _ in range(2):
        result = refresh.refresh_all(spark, root)
        assert (result.silver_rows, result.gold_rows) == (0, 0)
    tables.append_bronze(bronze([bar("A", "2024-01-02", 1)]), root, "t", 2)
    assert refresh.refresh_all(spark, root).gold_rows == 1


def test_a_gold_row_without_a_key_is_refused(spark, bronze, tmp_path):
    one = gold_features(build_silver(bronze([bar("A", "2024-01-02", 1)])))
    with pytest.raises(PySparkException, match="constraint broken"):
        refresh.upsert_gold(one.withColumn("symbol", F.lit(None).cast("string")), str(tmp_path))
    assert gold_of(spark, str(tmp_path)) == []


def test_a_gold_upsert_with_a_repeated_key_is_refused(spark, bronze, tmp_path):
    one = gold_features(build_silver(bronze([bar("A", "2024-01-02", 1)])))
    with pytest.raises(DuplicateKeyError):
        refresh.upsert_gold(one.unionByName(one), str(tmp_path))
    assert gold_of(spark, str(tmp_path)) == []


def test_a_run_loads_all_sources_before_silver(spark, bronze, tmp_path):
    good, empty = (RawBars(name, bronze(rows).selectExpr("*", "string(null) AS _raw",
                                                         "string(null) AS _reason"))
                   for name, rows in (("a", [bar("A", "2024-01-02", 1)]), ("b", [])))
    with pytest.raises(EmptySourceError):
        refresh.run(spark, [good, empty], str(tmp_path), 1)
    assert silver_of(spark, str(tmp_path)) == []
    result = refresh.run(spark, [good], str(tmp_path), 2)
    assert (result.silver_rows, result.gold_rows, result.quality["volume_is_negative"]) == (1, 1, 0)


def test_new_symbols_of_an_increment_need_no_stored_row(spark, bronze, tmp_path, monkeypatch):
    """One symbol comes whole, one is corrected far back and one goes on; also when silver has nothing."""
    root, rng = str(tmp_path), random.Random(21)
    old, next_, new = (random_series(rng, name, 60) for name in ("OLD", "NEXT", "NEW"))
    far, asked = refresh.gold_for_changes, []

    def watched(changes, *rest):
        asked.append({row["symbol"] for row in changes.select("symbol").distinct().collect()})
        return far(changes, *rest)

    monkeypatch.setattr(refresh, "gold_for_changes", watched)
    loads = [old + next_[:50], new + next_[50:] + [(*row[:8], 2) for row in old[:3]] + new[:5]]
    for number, rows in enumerate(loads, 1):
        refresh.run(spark, [RawBars("t", bronze(rows).withColumns(
            {"_raw": F.lit(None).cast("string"), "_reason": F.lit(None).cast("string")}))],
            root, number, full=False)
        silver, gold = expected(bronze([row for load in loads[:number] for row in load]))
        assert (silver_of(spark, root), gold_of(spark, root)) == (silver, gold)
    assert asked == [{"OLD"}]
    tail = rows_of(tables.read_table(spark, root, "silver_tail").select(*SILVER.names))
    refresh.refresh_tail(spark, root)
    assert rows_of(tables.read_table(spark, root, "silver_tail").select(*SILVER.names)) == tail
