"""Line dedup and SimHash groups against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barwright.llm import golay_simhash, line_dedup
from barwright.llm.common import table
from barwright.llm.components import components
from samples import SF

SPACES = " \t\n\x0b\x0c\r"


def lowered(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def kept_lines(rows):
    """(doc_id, text) -> (n_lines, n_dropped, kept), ids None counting as the largest."""
    order = lambda i: (i is None, i or 0)
    holders = defaultdict(set)
    key = lambda line: lowered(line.strip(SPACES))
    for i, text in rows:
        for line in (text or "").split("\n"):
            holders[key(line)].add(order(i))
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        stay = [x for x in lines if len(key(x)) < 10 or min(holders[key(x)]) == order(i)]
        out[i, text] = len(lines), len(lines) - len(stay), "\n".join(stay)
    return out


def test_line_dedup_equals_brute_force(odd_docs, odd_texts, no_docs):
    want = kept_lines(odd_texts)
    expected = [(i, n, d, hashlib.sha256(k.encode()).hexdigest())
                for i, t in odd_texts for n, d, k in [want[i, t]]]
    got = [tuple(r) for r in line_dedup.dedup_lines(odd_docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    assert line_dedup.dedup_lines(no_docs).collect() == []


def test_kept_rows_are_whole(odd_docs):
    kept = line_dedup.with_kept_lines(odd_docs)
    assert kept.select("row.*").exceptAll(odd_docs).isEmpty()
    assert kept.count() == odd_docs.count()
    assert kept.where("row.text IS NULL AND kept IS NOT NULL").isEmpty()


@pytest.mark.parametrize("partitions", ["1", "7", "40"])
def test_keys_may_reach_over_ranges(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    # One line in most documents, 130 lines a document: over two words of a bitmap.
    rows = [(i, "\n".join(["the same line everywhere" if (i + k) % 3 else f"line number {i} {k}"
                           for k in range(130)])) for i in range(30)]
    try:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        got = {r["doc_id"]: tuple(r)[1:] for r in line_dedup.dedup_lines(
            spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = kept_lines(rows)
    assert got == {i: (n, d, hashlib.sha256(k.encode()).hexdigest())
                   for i, t in rows for n, d, k in [want[i, t]]}


def test_line_dedup_runs_no_python(odd_docs):
    plan = line_dedup.dedup_lines(odd_docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def simhash(text):
    words = [w for w in lowered(text or "").translate(
        str.maketrans(dict.fromkeys(SPACES, " "))).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows, bits=4):
    """(doc_id, fingerprint, component) of each row, by comparing all pairs."""
    prints = [simhash(t) for _, t in rows]
    root = [*range(len(rows))]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= bits:
            root[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, f"{p:016x}", least.get(find(i)))
            for i, ((doc_id, _), p) in enumerate(zip(rows, prints))]


def near_copies(sf_docs):
    draw = random.Random(5)
    texts = [t for t in sf_docs.values() if len(t) > 400][:8]
    rows = [*sf_docs.items()]
    for n in range(200):
        words = draw.choice(texts).split(" ")
        for _ in range(draw.randrange(3)):
            words[draw.randrange(len(words))] = f"new{n}"
        rows.append((1000 + n, " ".join(words)))
    return rows


def test_simhash_groups_equal_brute_force(spark, sf_docs, odd_texts):
    rows = near_copies(sf_docs) + [(i and i + 5000, t) for i, t in odd_texts]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = [tuple(r) for r in golay_simhash.simhash_groups(docs).collect()]
    want = groups(rows)
    assert len({c for _, _, c in want}) < len({i for i, _ in rows}) - 100
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_query_equals_brute_force(spark, sf_docs):
    got = golay_simhash.simhash_groups(table(spark, SF, "documents")).collect()
    assert sorted(map(tuple, got)) == sorted(groups([*sf_docs.items()]))


def test_simhash_of_no_rows_and_of_odd_columns(odd_docs, no_docs):
    assert golay_simhash.simhash_groups(no_docs).collect() == []
    assert golay_simhash.simhash_groups(odd_docs).count() == odd_docs.count()


def test_one_of_each_keeps_whole_rows(odd_docs, odd_texts, no_docs):
    kept = golay_simhash.one_of_each(odd_docs)
    assert kept.columns == odd_docs.columns
    assert kept.exceptAll(odd_docs).isEmpty()
    classes = {c for _, _, c in groups(odd_texts)}
    roots = golay_simhash.near_duplicates(odd_docs).select("root").distinct().count()
    assert kept.count() == roots and {r["doc_id"] for r in kept.collect()} == classes
    assert golay_simhash.one_of_each(no_docs).collect() == []


def test_pairs_within_four_bits_share_a_key():
    draw = np.random.default_rng(6)
    base = draw.integers(0, 2**64, 3000, dtype=np.uint64)
    other = base.copy()
    for i in range(len(other)):
        for bit in draw.choice(64, draw.integers(1, 5), replace=False):
            other[i] ^= np.uint64(1) << np.uint64(bit)
    sets = []
    for values in (base, other):
        found = defaultdict(set)
        for key, owner in zip(*(x.tolist() for x in golay_simhash.keys(values))):
            found[owner].add(key)
        sets.append(found)
    assert all(sets[0][i] & sets[1][i] for i in range(len(base)))


def test_the_code_is_perfect():
    table_ = golay_simhash.error_patterns()
    assert sorted({*(table_ >= 0).sum(1).tolist()}) == [1, 6]
    weights = np.bitwise_count(table_[:, 0])
    assert np.bincount(weights).tolist() == [1, 23, 253, 1771]


def test_a_forest_joins_what_steps_join():
    draw = np.random.default_rng(7)
    for _ in range(30):
        fps = draw.integers(0, 2**9, 40).astype(np.uint64)
        links = golay_simhash.forest(fps, 2)
        root = {int(f): int(f) for f in fps}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in links:
            assert int(a ^ b).bit_count() <= 2
            root[find(int(a))] = find(int(b))
        for a, b in combinations({int(f) for f in fps}, 2):
            if (a ^ b).bit_count() <= 2:
                assert find(a) == find(b)
        assert len(links) == len(root) - len({find(x) for x in root})


def test_bridges_join_what_steps_between_blocks_join():
    draw = np.random.default_rng(9)
    for _ in range(20):
        left, right = (draw.integers(0, 2**8, 25).astype(np.uint64) for _ in range(2))
        left, right = np.unique(left), np.setdiff1d(right, left)
        links = golay_simhash.bridges(left, right, 1)
        pairs = [(a, b) for a in left.tolist() for b in right.tolist() if (a ^ b).bit_count() <= 1]
        assert {*links} <= {*pairs} and len(links) < len(left) + len(right)
        for joined in (links, pairs):
            root = {x: x for x in left.tolist() + right.tolist()}

            def find(x):
                while root[x] != x:
                    x = root[x]
                return x

            for a, b in joined:
                root[max(find(a), find(b))] = min(find(a), find(b))
            found = {x: find(x) for x in root}
            assert joined is links or found == before
            before = found


def test_keys_with_many_fingerprints_are_cut_into_blocks(spark):
    draw = np.random.default_rng(10)
    base = draw.integers(0, 2**63, 6)
    fps = {int(b) for b in base}
    for b in base.tolist():
        for _ in range(60):
            fps.add(b ^ sum(1 << int(k) for k in draw.choice(63, draw.integers(1, 6), replace=False)))
    rows = spark.createDataFrame([(f,) for f in fps], "fp long")

    def classes(block):
        links = golay_simhash.linked(rows, 4, block)
        return {frozenset(x) for x in _joined(fps, [tuple(r) for r in links.collect()])}

    want = {frozenset(x) for x in _joined(fps, [(a, b) for a, b in combinations(fps, 2)
                                                if (a ^ b).bit_count() <= 4])}
    assert classes(8) == classes(golay_simhash.BLOCK) == want


def _joined(nodes, links):
    root = {x: x for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(a)] = find(b)
    groups_ = defaultdict(set)
    for x in nodes:
        groups_[find(x)].add(x)
    return groups_.values()


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    edges += [(500, 501), (501, 502), (502, 500), (-3, 500)]
    random.Random(8).shuffle(edges)
    got = {r["node"]: r["root"] for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}
    assert got == want | {i: -3 for i in (-3, 500, 501, 502)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_hex_of_high_fingerprints(spark):
    rows = golay_simhash.simhash_groups(spark.createDataFrame(
        [(1, "b"), (2, "a b c d e")], "doc_id long, text string"))
    assert {r["fingerprint"] for r in rows.collect()} == {
        f"{simhash('b'):016x}", f"{simhash('a b c d e'):016x}"}
    assert rows.where(F.length("fingerprint") != 16).isEmpty()
