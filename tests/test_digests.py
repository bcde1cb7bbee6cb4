"""Reconciliation by digests against the comparison of all keys."""

from __future__ import annotations

import random
from pathlib import Path

from pyspark.sql import functions as F

from barwright.operators.gold import gold_features
from barwright.operators.quality import reconcile_layers
from barwright.operators.silver import build_silver
from barwright.plans import reconcile, refresh
from barwright.schemas import BRONZE
from barwright.sources import tables
from bars_help import bar, day, rows_of
from test_silver_gold import random_series


def all_keys(spark, root):
    return rows_of(reconcile_layers(*(tables.read_table(spark, root, name) for name in
                                      ("bronze_price_raw", "price_silver", "features_gold"))))


def test_digests_find_what_the_comparison_of_all_keys_finds(spark, bronze, tmp_path):
    root, rng = str(tmp_path), random.Random(1)
    tables.change_state(spark, root, lambda state: state.update(buckets=2))
    rows = [row for s in "ABCD" for row in random_series(rng, s, 60, 300)]
    tables.append_bronze(bronze([*rows, bar(None, "2024-01-02", 1)]), root, "t", 1)
    refresh.refresh_all(spark, root)
    assert rows_of(reconcile.reconcile_by_digest(spark, root)) == all_keys(spark, root) == []
    # Silver alone gets a row, gold another one.
    for name, build, symbol, dt in (("price_silver", lambda x: x, "A", "2031-05-05"),
                                    ("features_gold", gold_features, "B", "2032-06-07")):
        old = tables.read_table(spark, root, name).where(F.lit(False)).drop("ym", "bucket")
        new = build(build_silver(bronze([bar(symbol, dt, 3)])))
        tables.write_months(old.unionByName(new), root, name)
    found = reconcile.reconcile_by_digest(spark, root)
    assert rows_of(found) == all_keys(spark, root) == [
        ("A", day("2031-05-05"), False, True, False), ("B", day("2032-06-07"), False, False, True)]
    read = {Path(f).parent.parent.name for f in found.inputFiles() if "/ym=" in f}
    assert read == {"ym=203105", "ym=203206"}
    # A load that silver has not seen, with keys of its own.
    tables.append_bronze(bronze([bar("C", "2033-01-03", 1)]).select(*BRONZE.names), root, "t", 2)
    assert rows_of(reconcile.reconcile_by_digest(spark, root)) == all_keys(spark, root)


def test_digests_of_folders_that_did_not_change_are_kept(spark, bronze, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = [bar("A", f"2024-{m:02}-05", m) for m in range(1, 6)]
    tables.append_bronze(bronze(rows), root, "t", 1)
    refresh.refresh_all(spark, root)
    before = rows_of(reconcile.refresh_digests(spark, root))
    assert len(before) == 15
    asked = []
    read = reconcile.read_parts
    monkeypatch.setattr(reconcile, "read_parts", lambda s, r, name, parts: (
        asked.append((name, sorted(parts))), read(s, r, name, parts))[1])
    assert rows_of(reconcile.refresh_digests(spark, root)) == before and asked == []
    tables.append_bronze(bronze([bar("A", "2024-03-06", 9)]), root, "t", 2)
    refresh.refresh_increment(spark, root, [("t", 2)])
    reconcile.refresh_digests(spark, root)
    assert {name for name, _ in asked} == {"price_silver", "features_gold"}
    assert dict(asked)["price_silver"] == [(202403, 0)]
