"""Divergence of sources, substring dedup and the filter audit against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from barwright.llm import filter_audit, source_divergence, substring_dedup
from barwright.llm.source_divergence import Block

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# Divergence of sources

def naive_divergence(rows, least, top):
    """(lang, source, part, item, value, rank) by going over all terms of all pairs."""
    count, holds, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source, terms = lang or "", source or "", TERM.findall(lowered(text or ""))
        groups[lang].add(source)
        count[lang, source].update(terms)
        holds[lang].update({*terms})
    found = []
    for lang, sources in groups.items():
        kept = [t for t, n in holds[lang].items() if n >= least]
        total = Counter()
        for s in sources:
            total.update(count[lang, s])

        def shares(counts):
            n = sum(counts[t] for t in kept) + 5 * len(kept)
            return {t: 1 + 10**9 * (counts[t] + 5) // n for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(total)
        for s in sources:
            parts = {"pair": [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s],
                     "term": [(t, p[s][t] - q[t]) for t in kept
                              if count[lang, s][t] and p[s][t] > q[t]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                found += [(lang, s, part, item, value, i) for i, (item, value) in enumerate(items, 1)
                          if part == "pair" or i <= top]
    return sorted(found)


def some_groups(seed=3, n=400):
    draw = random.Random(seed)
    words = ["alpha", "Beta", "gamma'delta", "é漢", "x1y", "the", "THE", *(f"w{c}" for c in "abcdefghij")]
    return [(draw.choice(["en", "de", None]), draw.choice(["a", "b", "c", "d", None, ""]),
             " ".join(draw.choice(words[:draw.randrange(1, len(words))]) for _ in range(draw.randrange(30))))
            for _ in range(n)]


@pytest.mark.parametrize("least, top, block", [(30, 50, 4096), (2, 3, 4), (500, 50, 4096)])
def test_divergence_equals_all_pairs_of_all_terms(spark, monkeypatch, least, top, block):
    monkeypatch.setattr(source_divergence, "BLOCK", block)
    rows = some_groups()
    docs = spark.createDataFrame([(*r, "x") for r in rows], "lang string, source string, text string, n string")
    got = source_divergence.divergences(docs, least, top)
    assert sorted(map(tuple, got.collect())) == naive_divergence(rows, least, top)


def test_divergence_counts_in_several_flushes(spark, monkeypatch):
    monkeypatch.setattr(source_divergence, "HELD", 3)
    rows = some_groups(seed=5, n=60)
    docs = spark.createDataFrame(rows, "lang string, source string, text string")
    assert sorted(map(tuple, source_divergence.divergences(docs, 2, 9).collect())) \
        == naive_divergence(rows, 2, 9)


def test_divergence_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in odd_docs.collect()]
    got = source_divergence.divergences(odd_docs, 2, 50)
    assert sorted(map(tuple, got.collect())) == naive_divergence(rows, 2, 50)
    assert source_divergence.divergences(no_docs).count() == 0


def test_shares_are_exact_beyond_64_bits(spark):
    big = 9 * 10**17
    row = spark.range(1).select(source_divergence.share(
        *(source_divergence.F.lit(x).cast("long") for x in (big, 5 * big, 1000)))).first()
    assert row[0] == 1 + 10**9 * (big + 5) // (5 * big + 5000)


def test_block_accumulates_like_a_dense_matrix():
    draw = np.random.default_rng(7)
    for groups, terms in ((1, 3), (5, 40), (9, 7)):
        zero = draw.integers(1, 50, groups)
        dense = np.where(draw.random((groups, terms)) < 0.4, draw.integers(1, 10**9, (groups, terms)), 0)
        g, t = np.nonzero(dense)
        block = Block(t, g, dense[g, t], zero)
        full = np.where(dense > 0, dense, zero[:, None])[:, [*{*t.tolist()}]]
        for i in range(groups):
            assert block.accumulated(i).tolist() == np.abs(full - full[i]).sum(1).tolist()


# Substring dedup

def naive_substrings(rows):
    """(doc_id, n_words, n_removed, sha) by a table of all windows."""
    last, first = 2**63 - 1, {}
    texts = [(last if i is None else i, i, WORD.findall(t or "")) for i, t in rows]
    for order, _, words in texts:
        for at in range(len(words) - 12):
            key = tuple(words[at:at + 13])
            first[key] = min(first.get(key, order), order)
    found = []
    for order, doc, words in texts:
        gone = {at + j for at in range(len(words) - 12) if first[tuple(words[at:at + 13])] < order
                for j in range(13)}
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        found.append((doc, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(found, key=str)


def some_passages(seed=1, n=60):
    """Texts of few words that share passages, so that windows and minimisers repeat in many ways."""
    draw = random.Random(seed)
    words = ["a", "b", "ça", "d\x00", "漢字", "f", "g", "hh"]
    passage = [draw.choice(words) for _ in range(45)]
    rows = []
    for i in range(n):
        own = [draw.choice(words) for _ in range(draw.randrange(60))]
        at = draw.randrange(len(own) + 1)
        cut = draw.randrange(30)
        text = own[:at] + passage[cut:cut + draw.randrange(45)] + own[at:]
        rows.append((draw.randrange(n), draw.choice([" ", "\n", " \t "]).join(text)))
    return rows + [rows[0], (n, "a " * 200), (n + 1, "a " * 190), (None, rows[3][1]), (None, None)]


@pytest.mark.parametrize("hot", [1, 3, 10**6])
def test_substrings_equal_all_windows(spark, hot):
    rows = some_passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted(map(tuple, substring_dedup.remove_repeats(docs, hot).collect()), key=str)
    assert got == naive_substrings(rows)
    assert sum(r[2] for r in got) > 500


def test_substrings_in_small_steps(spark, monkeypatch):
    """Many buckets, stretches and cuts give the same."""
    for name, value in (("BUCKET", 20), ("STRETCH", 20), ("CUT", 300), ("PACKED", 700), ("HASHED", 16), ("COUNTED", 50)):
        monkeypatch.setattr(substring_dedup, name, value)
    rows = some_passages(seed=2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    got = sorted(map(tuple, substring_dedup.remove_repeats(docs).collect()), key=str)
    assert got == naive_substrings(rows)


def test_substrings_tell_words_of_one_hash_apart(monkeypatch):
    monkeypatch.setattr(substring_dedup, "hashes_of", lambda words, k: np.zeros(
        max(0, len(words) - k + 1), np.uint64))
    same, other = b"a b c d e f g h i j k l m", b"z b c d e f g h i j k l m"
    bits = substring_dedup.repeated(b" ".join([same, other, same + b" n", other]),
                                    np.array([1, 1, 2, 1]), np.array([4, 5, 6, 1]))
    assert bits.tolist() == [0, 1, 1, 0]


def test_substrings_of_odd_rows(spark, odd_docs, no_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = sorted(map(tuple, substring_dedup.remove_repeats(odd_docs).collect()), key=str)
    assert got == naive_substrings(rows)
    assert substring_dedup.remove_repeats(no_docs).count() == 0
    whole = substring_dedup.with_kept_words(odd_docs)
    assert whole.select("row.*").columns == odd_docs.columns
    assert whole.count() == len(rows)


def test_parcels_come_back_as_sent():
    draw = np.random.default_rng(2)
    columns = {"doc": draw.integers(-2**62, 2**62, 9), "text_key": draw.integers(-2**62, 2**62, 9),
               "pos": draw.integers(0, 2**31, 9), "windows": draw.integers(1, 33, 9)}
    words = [b"w%d \xff" % i for i in range(9)]
    found, text = substring_dedup.Parcel.read(substring_dedup.Parcel(**columns).part(2, 7, words), 5)
    assert text == b" ".join(words[2:7])
    assert [x.tolist() for x in found] == [x[2:7].tolist() for x in columns.values()]


def test_no_string_packs_more_windows_than_it_has_bits():
    strings = substring_dedup.Strings([(0, 0, [b"a"] * 500), (1, 7, [b"x"] * 12)])
    assert strings.windows.max() <= substring_dedup.LONGEST and strings.windows.sum() == 488
    assert {*strings.text.tolist()} == {0} and strings.pos.tolist()[:2] == [0, 32]


# Filter audit

def naive_audit(rows, labels):
    """The audit by applying each order to all documents."""
    least, good = {}, defaultdict(set)
    for doc, text, _ in rows:
        order = 2**63 - 1 if doc is None else doc
        least[text or ""] = min(least.get(text or "", order), order)
    for doc, quality, toxic in labels:
        if doc is not None:
            good[doc] |= {name for name, value in (("good", quality), ("toxic", toxic)) if value == 1}
    parts = defaultdict(list)
    for doc, text, lang in rows:
        text, words = text or "", WORD.findall(text or "")
        fails = {"A": len(words) < 100, "B": 100 * len({*words}) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
                 "D": bool(re.search("[#$%&*|]", text)),
                 "E": least[text] < (2**63 - 1 if doc is None else doc)}
        parts[lang or ""].append(({f for f in fails if fails[f]}, good.get(doc, set())))
    found = []
    for part, docs in parts.items():
        steps, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            for i, f in enumerate(order):
                earlier = {*order[:i]}
                alive = [d for d in docs if not d[0] & earlier]
                gone = [d for d in alive if f in d[0]]
                shapley[f] += len(gone)
                steps.append((f, (part, "".join(order), i + 1, len(alive) - len(gone), len(gone),
                                  sum(f in d[0] and bool(d[0] & earlier) for d in docs),
                                  sum(d[0] == {f} for d in docs), sum("good" in d[1] for d in gone),
                                  sum("toxic" in d[1] for d in gone))))
        found += [(*row, shapley[f]) for f, row in steps]
    return sorted(found)


def written(spark, rows, labels, folder):
    """One file after another, the largest ids first, so that later files take counts back."""
    for i, row in enumerate(rows):
        spark.createDataFrame([row], "doc_id long, text string, lang string, shard int").coalesce(1) \
            .write.mode("append").parquet(str(folder))
    return spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_audit_takes_back_what_smaller_ids_undo(spark, tmp_path):
    long = " ".join(f"word{i}" for i in range(120))
    rows = [(9, "A COPY", "en", 1), (None, "A COPY", "en", 1), (8, long, "de", 1), (7, "A COPY", "de", 1),
            (7, "A COPY", None, 1), (4, long, "en", 1), (3, "A COPY", "en", 1), (5, None, "en", 1),
            (2, "", "de", 1), (1, long + " #", "en", 1)]
    labels = [(9, 1, 0), (9, 0, 1), (4, 1, None), (None, 1, 1), (7, 0, 1), (99, 1, 1), (2, None, 1)]
    table = written(spark, rows, labels, tmp_path / "documents.parquet")
    want = naive_audit([r[:3] for r in rows], labels)
    for batches in (1, 3, 10):
        got = filter_audit.audit(spark, str(tmp_path / "documents.parquet"), table, batches)
        assert sorted(map(tuple, got.collect())) == want


def test_holders_take_back_and_settle():
    holders, changes = filter_audit.Holders(), Counter()
    late = filter_audit.LATER
    for doc, kind in ((5, 1), (3, 2), (4, 1), (3, 2)):
        holders.add(changes, b"t", doc, ("p", kind), 1)
    assert {k: n for k, n in changes.items() if n} == {("p", 1 | late): 2, ("p", 2): 2}
    assert holders[b"t"] == (3, {("p", 2): 2})


def test_audit_of_odd_rows(spark, odd_docs, no_docs, tmp_path):
    odd_docs.repartition(3).write.parquet(str(tmp_path / "odd"))
    no_docs.write.parquet(str(tmp_path / "none"))
    labels = [(1, 1, 0), (5, 1, 1), (10, 0, 1)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd_docs.collect()]
    got = filter_audit.audit(spark, str(tmp_path / "odd"), table)
    assert sorted(map(tuple, got.collect())) == naive_audit(rows, labels)
    assert filter_audit.audit(spark, str(tmp_path / "none"), table).count() == 0


def test_audit_reduces_copies_before_the_shuffle(spark):
    rows = spark.createDataFrame([(b"t" * 16, i, "en", 0) for i in range(500)],
                                 "text binary, doc long, part string, class int").coalesce(1)
    got = filter_audit.reduced(rows, 4).collect()
    assert len(got) == 2 and {(r["doc"], r["class"], r["n"]) for r in got} == {
        (0, 0, 1), (None, filter_audit.LATER, 499)}
