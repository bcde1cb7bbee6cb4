"""The state of stored tables, compaction and replacement of loads, other bucket counts, kept rows."""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from barwright.operators import tail as tails
from barwright.operators.gold import HALO, gold_features
from barwright.operators.serving import latest_features
from barwright.operators.silver import build_silver
from barwright.plans import refresh
from barwright.schemas import GOLD, KEY, SILVER
from barwright.session import place_once, read_text
from barwright.sources import state, tables
from bars_help import bar, day, price, rows_of
from test_silver_gold import random_series


def table_rows(spark, root, name):
    columns = (SILVER if name.startswith(("price", "silver")) else GOLD).names
    return rows_of(tables.read_table(spark, root, name).select(*columns))


def load(bronze, root, batch, rows, source="t"):
    tables.append_bronze(bronze(rows), root, source, batch)
    tables.note_loads(bronze(rows).sparkSession, root, [(batch, source, batch)], "loaded")


def test_a_file_is_placed_once_however_many_try(spark, tmp_path):
    path = str(tmp_path / "x" / "1.json")
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda n: place_once(spark, path, f"é{n}"), range(16)))
    assert sum(won) == 1 and read_text(spark, path) == f"é{won.index(True)}"
    assert [p.name for p in Path(path).parent.iterdir() if not p.name.startswith(".")] == ["1.json"]


def test_writers_side_by_side_never_share_a_number(spark, tmp_path):
    root = str(tmp_path)
    with ThreadPoolExecutor(6) as pool:
        numbers = list(pool.map(lambda n: tables.load_number(spark, root, f"s{n}", 0, count=2), range(24)))
    assert sorted(numbers) == [*range(1, 49, 2)]


def test_the_state_does_not_grow_with_micro_batches(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(60):
        number = tables.load_number(spark, root, "live", batch)
        tables.note_loads(spark, root, [(number, "live", batch)], "loaded")
        assert tables.load_number(spark, root, "live", batch) == number == batch + 1
        tables.note_loads(spark, root, [(number, "live", batch)], "applied")
    assert len([*Path(root, state.FOLDER).glob("*.json")]) <= state.KEPT_VERSIONS
    assert [tuple(r) for r in tables.loads(spark, root).collect()] == [(60, "live", 59, "applied")]
    assert len(str(state.read_state(spark, root))) < 200


def test_a_change_is_made_again_on_what_others_left(spark, tmp_path):
    root, tries = str(tmp_path), []

    def change(now):
        tries.append(dict(now))
        if len(tries) == 1:  # somebody else is faster
            state.change_state(spark, root, lambda other: other.update(a=1))
        now["b"] = now.get("a", 0) + 1

    state.change_state(spark, root, change)
    assert tries == [{}, {"a": 1}] and state.read_state(spark, root) == {"a": 1, "b": 2}


@pytest.mark.parametrize("numbers", [[], [3], [1, 2, 3, 7, 9, 10]])
def test_ranges_hold_numbers(numbers):
    ranges = state.as_ranges(numbers)
    assert [n for n in range(12) if state.in_ranges(n, ranges)] == numbers
    for n in range(12):
        assert state.without(ranges, n) == state.as_ranges([x for x in numbers if x != n])


def bronze_rows(spark, root):
    return sorted((r["symbol"], int(r["close"]), r["batch"]) for r in tables.read_table(
        spark, root, "bronze_price_raw").collect())


def test_a_gathered_load_can_be_replaced_withdrawn_and_added_to(spark, bronze, tmp_path):
    root = str(tmp_path)
    for batch in range(1, 5):
        load(bronze, root, batch, [bar(f"S{batch}", "2024-01-02", 10 * batch)])
    refresh.refresh_increment(spark, root)
    assert tables.compact_bronze(spark, root, "t") == 3
    whole = [("S1", 10, 1), ("S2", 20, 2), ("S3", 30, 3), ("S4", 40, 4)]
    assert bronze_rows(spark, root) == whole
    assert rows_of(tables.read_bronze_loads(spark, root, [("t", 2), ("t", 4)]), "symbol", "batch") == [
        ("S2", 2), ("S4", 4)]
    tables.replace_bronze_batch(bronze([bar("S1", "2024-01-02", 9)]), root, "t", 1)
    tables.replace_bronze_batch(bronze([]), root, "t", 2)
    tables.append_bronze(bronze([bar("X", "2024-01-02", 5)]), root, "t", 3)
    now = [("S1", 9, 1), ("S3", 30, 3), ("S4", 40, 4), ("X", 5, 3)]
    assert bronze_rows(spark, root) == now
    refresh.refresh_all(spark, root)
    assert [(r[0], r[5]) for r in table_rows(spark, root, "price_silver")] == [
        ("S1", price(9)), ("S2", price(20)), ("S3", price(30)), ("S4", price(40)), ("X", price(5))]
    # What was taken out is gathered again, in a folder of its own.
    assert tables.compact_bronze(spark, root, "t") == 3
    assert bronze_rows(spark, root) == now and tables.compact_bronze(spark, root, "t") == 0


def test_many_gathered_folders_become_one(spark, bronze, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "MOST_GATHERED", 2)
    root, want = str(tmp_path), []
    for batch in range(1, 6):
        load(bronze, root, batch, [bar(f"S{batch}", "2024-01-02", batch)])
        tables.note_loads(spark, root, [(batch, "t", batch)], "applied")
        want.append((f"S{batch}", batch, batch))
        tables.compact_bronze(spark, root, "t")
        assert bronze_rows(spark, root) == want
        assert len([*Path(root).glob("bronze_price_raw/source=t/*")]) <= 3


@pytest.mark.parametrize("lost", ["before", "after"])
def test_a_job_lost_while_gathering_copies_nothing_twice(spark, bronze, tmp_path, monkeypatch, lost):
    root = str(tmp_path)
    for batch in range(1, 4):
        load(bronze, root, batch, [bar("A", f"2024-01-0{batch}", batch)])
        tables.note_loads(spark, root, [(batch, "t", batch)], "applied")
    want = bronze_rows(spark, root)

    def stop(*args):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(tables, "change_state" if lost == "before" else "remove", stop)
        with pytest.raises(KeyboardInterrupt):
            tables.compact_bronze(spark, root, "t")
    assert bronze_rows(spark, root) == want
    tables.compact_bronze(spark, root, "t")
    assert bronze_rows(spark, root) == want
    assert len([*Path(root).glob("bronze_price_raw/source=t/*")]) == 2


def test_loads_that_are_being_written_are_not_gathered(spark, bronze, tmp_path):
    root = str(tmp_path)
    for batch in (1, 2, 3):
        load(bronze, root, batch, [bar("A", f"2024-01-0{batch}", batch)])
    tables.note_loads(spark, root, [(1, "t", 1)], "started")
    tables.note_loads(spark, root, [(3, "t", 3)], "applied")
    assert tables.pending_loads(spark, root) == [(2, "t", 2)]
    assert tables.compact_bronze(spark, root, "t") == 0


def filled(spark, bronze, root, seed=4):
    rng = random.Random(seed)
    rows = [row for n in range(12) for row in random_series(rng, f"S{n}", 25, 60)]
    load(bronze, root, 1, rows)
    refresh.refresh_all(spark, root)
    return rows


BUCKETED = ("price_silver", "features_gold", "silver_tail", "gold_latest")


def test_other_bucket_counts_keep_all_rows(spark, bronze, tmp_path):
    root = str(tmp_path)
    filled(spark, bronze, root)
    before = {name: table_rows(spark, root, name) for name in BUCKETED}
    assert tables.buckets(spark, root) == 1
    tables.rebucket(spark, root, 3)
    assert tables.buckets(spark, root) == 3
    assert {name: table_rows(spark, root, name) for name in BUCKETED} == before
    assert {p.name for p in Path(root, "price_silver").glob("ym=*/bucket=*")} == {
        "bucket=0", "bucket=1", "bucket=2"}
    load(bronze, root, 2, [bar("S3", "2030-01-02", 5, seq=9)])
    refresh.refresh_increment(spark, root)
    assert len(table_rows(spark, root, "price_silver")) == len(before["price_silver"]) + 1
    # A month and symbol opens one folder.
    one = tables.read_parts(spark, root, "price_silver", tables.touched_parts(
        bronze([bar("S3", "2030-01-02", 5)]), root))
    assert len(one.inputFiles()) == 1


def test_a_driver_lost_while_buckets_change_leaves_the_rest_to_the_next(spark, bronze, tmp_path, monkeypatch):
    root = str(tmp_path)
    filled(spark, bronze, root)
    before = {name: table_rows(spark, root, name) for name in BUCKETED}
    moves = []

    def move_twice(*args):
        moves.append(args)
        if len(moves) > 2:
            raise KeyboardInterrupt
        return rename(*args)

    rename = tables.rename
    with monkeypatch.context() as patch:
        patch.setattr(tables, "rename", move_twice)
        with pytest.raises(KeyboardInterrupt):
            tables.rebucket(spark, root, 5)
    refresh.refresh_all(spark, root)
    assert tables.buckets(spark, root) == 5
    assert {name: table_rows(spark, root, name) for name in BUCKETED} == before


def test_the_size_of_a_month_settles_the_buckets(spark, tmp_path):
    root = str(tmp_path)
    assert tables.settle_buckets(spark, root, 10 * tables.BUCKET_BYTES / tables.ROW_BYTES) == 10
    assert tables.settle_buckets(spark, root, 1) == tables.buckets(spark, root) == 10


def test_new_days_read_the_tail_only(spark, bronze, tmp_path):
    root = str(tmp_path)
    rng = random.Random(6)
    rows = [row for s in "ABC" for row in random_series(rng, s, 120, 200)]
    load(bronze, root, 1, rows)
    refresh.refresh_all(spark, root)
    last = max(r[1] for r in rows)
    new = [bar(s, f"{last.year + 1}-01-{d:02}", d + 3, seq=2) for s in "AB" for d in (2, 3, 4)]
    fix = [(*[r for r in rows if r[0] == "C"][-3][:5], price(77), 5, "t", 2)]
    changes = build_silver(bronze(new + fix))
    before = tables.read_table(spark, root, "silver_tail").drop("bucket")
    after = tails.advance_tail(before, changes)
    assert {r["far"] for r in tails.reach_of_tail(after, changes).collect()} == {False}
    found = tails.gold_from_tail(after, changes)
    assert all("/silver_tail/" in f for f in found.inputFiles())
    want = gold_features(build_silver(bronze(rows + new + fix)))
    keys = {(r[0], r[1]) for r in rows_of(found)}
    assert len(keys) == 6 + 3
    assert rows_of(found) == [r for r in rows_of(want.select(*GOLD.names)) if (r[0], r[1]) in keys]


@pytest.mark.parametrize("seed", range(2))
def test_tail_and_newest_features_follow_every_increment(spark, bronze, tmp_path, seed):
    rng, root = random.Random(seed), str(tmp_path)
    rows = [row for s in ("A", "B", "C") for row in random_series(rng, s, rng.randrange(3, 150), 200)]
    rng.shuffle(rows)
    cut = sorted(rng.sample(range(1, len(rows)), 2))
    loads = [rows[:cut[0]], rows[cut[0]:cut[1]], rows[cut[1]:]]
    loads.append([(*r[:5], price(rng.randrange(1, 99)), r[6], "t", rng.randrange(3)) for r in rng.sample(rows, 6)])
    for batch, part in enumerate(loads, 1):
        load(bronze, root, batch, part)
        refresh.refresh_increment(spark, root)
        silver = tables.read_table(spark, root, "price_silver").select(*SILVER.names)
        gold = tables.read_table(spark, root, "features_gold").select(*GOLD.names)
        assert tables.is_kept(spark, root, "silver_tail") and tables.is_kept(spark, root, "gold_latest")
        assert table_rows(spark, root, "silver_tail") == rows_of(tails.last_rows(silver))
        assert table_rows(spark, root, "gold_latest") == rows_of(latest_features(gold))
        assert rows_of(gold) == rows_of(gold_features(silver))


def test_symbols_corrected_further_back_are_out_of_reach(spark, bronze):
    rows = [bar("A", f"2024-{m:02}-{d:02}", m + d) for m in (1, 2) for d in range(1, 20)]
    tail = build_silver(bronze(rows))
    assert tail.count() == tails.TAIL
    one = lambda dt, symbol="A": bronze([bar(symbol, dt, 1)])
    far = lambda *row, tail=tail: tails.reach_of_tail(tail, one(*row)).first()["far"]
    assert not far(rows[HALO][1].isoformat()) and far(rows[HALO - 1][1].isoformat())
    # A symbol that has fewer rows than a tail holds is there with all of them.
    assert not far("2024-01-02", tail=tail.where("dt > DATE'2024-01-01'")) and far("2024-01-02", "NEW")
    news = lambda dt: tails.within_tail(tail, one(dt)).count()
    assert (news("2023-12-31"), news("2024-01-01"), news("2025-01-01")) == (0, 1, 1)


def test_other_writes_put_the_kept_tables_out_of_date(spark, bronze, tmp_path):
    root = str(tmp_path)
    filled(spark, bronze, root)
    rows = build_silver(bronze([bar("NEW", "2024-01-02", 1)]))
    tables.write_months(rows, root, "price_silver")
    tables.write_months(gold_features(rows), root, "features_gold")
    assert not tables.is_kept(spark, root, "silver_tail")
    assert not tables.is_kept(spark, root, "gold_latest")
    gold = tables.read_table(spark, root, "features_gold").select(*GOLD.names)
    assert rows_of(tables.latest_rows(spark, root)) == rows_of(latest_features(gold))
    load(bronze, root, 2, [bar("NEW", "2024-01-03", 2)])
    refresh.refresh_increment(spark, root)
    assert ("NEW", day("2024-01-03"), 1.0) in rows_of(tables.latest_rows(spark, root), *KEY, "ret1d")
    refresh.refresh_all(spark, root)
    assert tables.is_kept(spark, root, "silver_tail") and tables.is_kept(spark, root, "gold_latest")


def test_price_sketches_of_touched_months_replace_theirs(spark, bronze, tmp_path):
    root = str(tmp_path)
    rows = filled(spark, bronze, root)
    refresh.refresh_price_sketches(spark, root)
    first = rows[0]
    load(bronze, root, 2, [(*first[:5], price(50000), *first[6:8], 9)])
    refresh.refresh_increment(spark, root)
    parts = tables.touched_parts(bronze([first]), root)
    refresh.refresh_price_sketches(spark, root, parts)
    silver = tables.read_table(spark, root, "price_silver")
    sketches = refresh.read_price_sketches(spark, root)
    assert sketches.agg(F.sum("n_rows")).first()[0] == silver.count()
    top = sketches.where(F.col("symbol") == first[0]).agg(
        F.max(F.kll_sketch_get_quantile_double("sketch", F.lit(1.0)))).first()[0]
    assert top == 50000.0
