"""Classifiers by held-out accuracy, the mix by its contract, and the pipeline stage by stage."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from barwright.llm import language_id, quality, source_mix
from barwright.llm.common import stored, table
from barwright.llm.queries import ORACLE, QUERIES
from samples import LONG, SF
from test_dedup import groups, kept_lines

BIG = "/root/testdata/sf0.01"


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_quality_on_held_out_labels(spark):
    labels = {r["doc_id"]: r["quality"] for r in pq.read_table(f"{BIG}/labels.parquet").to_pylist()}
    rows = quality.scored(table(spark, BIG, "documents"), table(spark, BIG, "labels")).collect()
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    told = [r for r in rows if r["held_out"] and r["doc_id"] in labels]
    right = np.mean([r["predicted"] == labels[r["doc_id"]] for r in told])
    good = [r["score"] for r in told if labels[r["doc_id"]] == 1]
    bad = [r["score"] for r in told if labels[r["doc_id"]] == 0]
    assert right > 0.95
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_held_out_labels_change_no_score(spark):
    docs, labels = table(spark, BIG, "documents"), table(spark, BIG, "labels")
    turned = labels.withColumn("quality", F.when(
        F.crc32(F.col("doc_id").cast("string")) % 3 == 1, 1 - F.col("quality"))
        .otherwise(F.col("quality")))
    one, two = (dict(quality.scored(docs, x).select("doc_id", "score").collect())
                for x in (labels, turned))
    assert max(abs(one[i] - two[i]) for i in one) < 1e-6


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(3, 1, 0), (4, 0, 0), (4, 0, 0), (9, None, 1), (None, 1, 0), (8, 7, 0)],
        "doc_id long, quality int, toxic int")
    rows = quality.scored(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    none = quality.scored(odd_docs, labels.limit(0)).collect()
    assert {r["score"] for r in none} == {0.5}
    assert quality.scored(no_docs, labels).collect() == []
    kept = quality.good_documents(odd_docs, labels.limit(0))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_rising_is_the_nearest_rising_sequence():
    got = quality.rising(np.array([0.1, 0.5, 0.3, 0.2, 0.9]), np.array([1.0, 1, 1, 2, 1]))
    assert np.allclose(got, [0.1, 0.3, 0.3, 0.3, 0.9])


def test_statistics_are_finite():
    for text in ["", " ", "\n" * 9, LONG, "😀" * 99, "\x00"]:
        assert np.isfinite(quality.statistics(text)).all()


def test_language_on_held_out_documents(spark):
    langs = {r["doc_id"]: r["lang"] for r in pq.read_table(
        f"{BIG}/documents.parquet", columns=["doc_id", "lang"]).to_pylist()}
    rows = language_id.identify(table(spark, BIG, "documents")).collect()
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in rows)
    told = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in told]) > 0.97
    taken = [r for r in told if r["accepted"]]
    assert len(taken) > 0.9 * len(told)
    assert np.mean([r["lang_pred"] == langs[r["doc_id"]] for r in taken]) > 0.98


def test_rare_languages_are_learnt_from_any_table(spark):
    rare = {"x" + c: f"{c}{c}u {c}o{c} {c}{c}{c}a" for c in "bdfgkmnpqw"}
    rows = [(i, f"the cat and the dog of house {i}", "en") for i in range(9000)]
    rows += [(20_000 + 40 * n + k, f"{words} " * (k % 5 + 3), lang)
             for n, (lang, words) in enumerate(rare.items()) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.learnt(docs, sample=100)
    assert model.languages == sorted(["en", *rare])
    assert [model.predict(words * 4)[0] for words in rare.values()] == [*rare]


def test_shares_of_languages():
    assert language_id.fair_share([5000, 300, 9000], 3000) == 1350
    assert language_id.fair_share([700] * 100, 3000) == language_id.LEAST
    assert language_id.fair_share([7, 9], 3000) >= 9
    assert language_id.fair_share([], 3000) >= 0


def test_small_samples_of_many_rows_are_not_empty(spark):
    from barwright.llm.common import bounded_sample
    rows = spark.range(8_000_000).withColumnRenamed("id", "doc_id")
    assert 1 <= bounded_sample(rows, 7).count() <= 25


def test_language_of_odd_rows(spark, odd_docs, odd_texts, no_docs):
    rows = language_id.identify(odd_docs).collect()
    assert len(rows) == len(odd_texts)
    letters = lambda t: any(c.isalpha() for c in t or "")
    want = sorted((i is None, i or 0, "en" if letters(t) else "und") for i, t in odd_texts)
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["lang_pred"]) for r in rows) == want
    assert language_id.identify(no_docs).collect() == []
    unknown = language_id.identify(odd_docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in unknown.collect()} == {"und"}


def test_long_texts_are_read_in_parts(monkeypatch):
    model = language_id.train(["the cat and the dog " * 9, "der Hund und die Katze " * 9] * 8,
                              ["en", "de"] * 8)
    whole = model.averages(LONG)
    monkeypatch.setattr(language_id, "AT_ONCE", 1000)
    assert np.allclose(whole, model.averages(LONG), rtol=1e-4)


def targets(sizes):
    """Targets by name, from the words of the contract."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {s: 0.0 for s in names if not sizes[s]}, sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weights[s] for s in rest)
        over = [s for s in rest if left * weights[s] / w > 3 * sizes[s] * (1 + 1e-12)]
        if not over:
            return fixed | {s: left * weights[s] / w for s in rest}
        fixed |= {s: 3.0 * sizes[s] for s in over}


def check_mix(rows, docs):
    """docs: (doc_id, text, source)."""
    size = lambda t: len((t or "").encode().split())
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + size(text)
    want = targets(sizes)
    assert sorted((str(r["doc_id"]), r["size"], r["source_size"]) for r in rows) == sorted(
        (str(i), size(t), sizes[s]) for i, t, s in docs)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in rows)
    by_target = {}
    for r in rows:
        total = by_target.setdefault((r["source_size"], round(r["target"], 6)), [0])
        total[0] += r["taken"]
    expected = {}
    for source, goal in want.items():
        entry = expected.setdefault((sizes[source], round(goal, 6)), [0])
        entry[0] += goal
    assert by_target.keys() == expected.keys()
    for key, (total,) in by_target.items():
        assert abs(total - expected[key][0]) <= max(3, 0.02 * expected[key][0])


def test_mix_of_the_table(spark):
    docs = pq.read_table(f"{BIG}/documents.parquet", columns=["doc_id", "text", "source"]).to_pylist()
    rows = source_mix.mix_sources(table(spark, BIG, "documents")).collect()
    check_mix(rows, [(r["doc_id"], r["text"], r["source"]) for r in docs])
    again = source_mix.mix_sources(table(spark, BIG, "documents").repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_mix_of_odd_rows(odd_docs, no_docs):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in odd_docs.collect()]
    check_mix(source_mix.mix_sources(odd_docs).collect(), docs)
    assert source_mix.mix_sources(no_docs).collect() == []
    assert source_mix.mixed_documents(no_docs).collect() == []


def test_mix_cuts_one_document_of_a_source_at_most(spark):
    docs = table(spark, BIG, "documents")
    sources = {r["doc_id"]: r["source"] for r in docs.select("doc_id", "source").collect()}
    cut, gained, goals = {}, {}, {}
    for r in source_mix.mix_sources(docs).collect():
        source = sources[r["doc_id"]]
        goals[source] = r["target"]
        gained[source] = gained.get(source, 0) + r["taken"]
        cut[source] = cut.get(source, 0) + (r["size"] > 0 and r["taken"] % r["size"] > 0)
    assert max(cut.values()) <= 1
    assert all(gained[s] == round(goals[s]) for s in goals)


def naive_mix(mix):
    """(doc_id, size) -> words taken, (turn, shard, place) of each pass, by walking along each source's
    permuted blocks."""
    plan = mix.plan
    where = {(int(r.source), int(r.turn), int(r.block)): (n, r.places.tolist())
             for n in range(plan.shards) for r in plan.placed(n).itertuples()}
    buckets = max(1, -(-mix.rows.where("size > 0").count() // source_mix.BUCKET))
    hashed = lambda salt: F.xxhash64("doc_id", "text_key", F.lit(salt))
    rows = mix.rows.where("size > 0").select(
        "doc_id", "size", "source", F.pmod(hashed("mix"), F.lit(buckets)).alias("bucket"),
        hashed("row").alias("at")).collect()
    found, quota = [], [0] * len(plan.names)
    for number, name in enumerate(plan.names):
        row = sorted((r for r in rows if r["source"] == name), key=lambda r: (r["bucket"], r["at"]))
        blocks = [[*range(len(row))][i:i + plan.block_docs] for i in range(0, len(row), plan.block_docs)]
        left, turn, taken = round(min(plan.targets[number], 3 * plan.sizes[number])), 0, {}
        while left > 0:
            order = plan.permuted(number, turn, np.arange(len(blocks))).tolist()
            for block in order:
                if left <= 0:
                    break
                quota[number] += 1
                shard, places = where[number, turn, block]
                for i, at in enumerate(blocks[block]):
                    gain = min(left, row[at]["size"])
                    left -= gain
                    if gain:
                        taken.setdefault(at, []).append((gain, shard, places[i]))
            turn += 1
        found += [(r["doc_id"], r["size"], sum(t[0] for t in taken.get(i, [])),
                   [t[1] for t in taken.get(i, [])], [t[2] for t in taken.get(i, [])])
                  for i, r in enumerate(row)]
    assert quota == plan.quotas
    return sorted(found)


def test_mix_equals_a_walk_along_the_blocks(spark):
    mix = source_mix.Mix(table(spark, BIG, "documents"), shard_blocks=20)
    assert mix.plan.shards > 10
    rows = [r for r in mix.taken().collect() if r["size"]]
    assert sorted((r["doc_id"], r["size"], r["taken"], r["shards"], r["places"]) for r in rows) \
        == naive_mix(mix)
    placed = [x for r in rows for x in zip(r["shards"], r["places"])]
    assert len(placed) == len({*placed})


def test_the_tree_decides_where_documents_go(spark):
    tree = source_mix.Mix(table(spark, BIG, "documents"), shard_blocks=20)
    want = {r["doc_id"]: (r["taken"], r["shards"]) for r in tree.taken().collect()}
    quotas = tree.plan.quotas
    tree.plan.shard = lambda number: ([0] * len(quotas), [q * (number == 0) for q in quotas])
    tree.placements = source_mix.placements(spark, tree.plan)
    flat = {r["doc_id"]: (r["taken"], r["shards"]) for r in tree.taken().collect()}
    assert {i: t for i, (t, _) in want.items()} == {i: t for i, (t, _) in flat.items()}
    assert {s for _, shards in flat.values() for s in shards} == {0}
    assert {s for _, shards in want.values() for s in shards} == {*range(tree.plan.shards)}


def test_mixed_documents_stand_by_shard_and_place(spark):
    docs = table(spark, BIG, "documents")
    mix = source_mix.Mix(docs, shard_blocks=20)
    want = {}
    for r in mix.taken().collect():
        for shard, place in zip(r["shards"], r["places"]):
            want.setdefault(shard, []).append((place, r["doc_id"]))
    got = [[r["doc_id"] for r in part] for part in mix.texts(docs).rdd.glom().collect()]
    order = {s: [i for _, i in sorted(x)] for s, x in want.items()}
    first = {tuple(x[:4]): x for x in order.values()}
    for part in filter(None, got):  # a partition is whole shards one after another
        while part:
            shard = first.pop(tuple(part[:4]))
            assert part[:len(shard)] == shard
            part = part[len(shard):]
    assert not first


@pytest.mark.parametrize("urn", [2, 30, 10**9])
def test_draws_have_the_moments_of_the_hypergeometric(urn):
    rng = np.random.default_rng(4)
    for good, bad, draws in ((40, 60, 30), (5, 95, 50), (70, 3, 20)):
        n = good + bad
        found = np.array([source_mix.hypergeometric(rng, good, bad, draws, urn) for _ in range(6000)])
        mean, spread = draws * good / n, draws * good * bad * (n - draws) / n**2 / (n - 1)
        assert max(0, draws - bad) <= found.min() and found.max() <= min(good, draws)
        assert abs(found.mean() - mean) < 5 * (spread / len(found)) ** 0.5
        assert abs(found.var() / spread - 1) < 0.12


def test_draws_from_urns_of_any_size():
    rng = np.random.default_rng(5)
    counts = [10**13, 3, 5 * 10**12, 0]
    out = source_mix.dealt(rng, counts, 6 * 10**12)
    assert sum(out) == 6 * 10**12 and all(0 <= a <= b for a, b in zip(out, counts))
    assert abs(out[0] / (4 * 10**12) - 1) < 1e-5


def some_plan(shard_blocks):
    plan = source_mix.Plan({"a": (50_000, 9_000), "b": (700, 90), None: (9_000, 2_001)},
                           shard_blocks=shard_blocks)
    plan.settle({0: 1_500, 1: 20, 2: 300})
    return plan


def test_places_turn_the_permutation_back():
    plan = some_plan(1024)
    blocks = np.arange(plan.blocks[0])
    assert (plan.places(0, 2, plan.permuted(0, 2, blocks)) == blocks).all()


def test_targets_stop_at_three_times_the_size():
    assert source_mix.shared_targets([10, 1000, 0], [5, 2, 1]) == [30.0, 980.0, 0.0]
    assert source_mix.shared_targets([], []) == []
    assert sum(source_mix.shared_targets([7, 90, 3, 800], [5, 2, 1, 5])) == pytest.approx(900)


def test_shards_share_out_every_quota():
    plan = some_plan(37)
    rows = [plan.placed(n) for n in range(plan.shards)]
    sizes = [len(r) for r in rows]
    assert plan.shards > 20 and max(sizes) - min(sizes) <= 1
    for source, quota in enumerate(plan.quotas):
        taken = sorted((int(t), int(b)) for r in rows
                       for t, b in r.loc[r["source"] == source, ["turn", "block"]].values)
        assert len(taken) == len({*taken}) == quota
        whole = quota // plan.blocks[source]
        assert [x for x in taken if x[0] < whole] == [
            (t, b) for t in range(whole) for b in range(plan.blocks[source])]
    for r in rows:
        assert sorted(x for places in r["places"] for x in places) == [*range(4 * len(r))]


def test_blocks_are_permuted():
    plan = some_plan(1024)
    order = plan.permuted(0, 0, np.arange(plan.blocks[0]))
    assert sorted(order) == [*range(plan.blocks[0])]
    assert abs(np.corrcoef(order, np.arange(len(order)))[0, 1]) < 0.1
    assert (order != plan.permuted(0, 1, np.arange(plan.blocks[0]))).any()


def test_mixed_documents_hold_the_words_taken(spark, odd_docs):
    mix = source_mix.Mix(odd_docs)
    taken = sum(r["taken"] for r in mix.taken().collect())
    texts = mix.texts(odd_docs)
    rows = texts.collect()
    assert texts.columns == odd_docs.columns
    assert sum(len(r["text"].encode().split()) for r in rows) == taken
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    whole = {(r["doc_id"], r["text"]) for r in odd_docs.collect()}
    for r in rows:
        assert any(i == r["doc_id"] and all(part in t for part in r["text"].split("\n"))
                   for i, t in whole if t)


def test_first_words_keep_what_stands_between(spark):
    rows = spark.createDataFrame([(" a  b\tc d ", 3), ("x\n\ny z", 1), ("\x0b é\u00a0f g", 1)],
                                 "text string, n int")
    got = [r[0] for r in rows.select(source_mix.first_words(F.col("text"), F.col("n"))).collect()]
    assert got == ["a  b\tc", "x", "é\u00a0f"]


def test_pipeline_rows_stage_by_stage(spark):
    """Each stage on its own input against a plain version of it."""
    docs = start = table(spark, SF, "documents")
    seen = {}
    assert len(corpus_pipeline.STAGES) == 5
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stored(stage(spark, docs, SF), "stage")
        rows = [(r["doc_id"], r["text"]) for r in before.select("doc_id", "text").collect()]
        got = docs.collect()
        seen[name] = len(got)
        if name != "sentence pieces":
            assert docs.columns == start.columns, name
            assert all(r["n_chars"] == len(r["text"]) for r in got if name != "quality classifier")
        pairs = sorted((r["doc_id"], r["text"]) for r in got) if "text" in docs.columns else None
        if name == "quality classifier":
            score = {r["doc_id"]: r["predicted"] for r in quality.scored(
                before, table(spark, SF, "labels")).collect()}
            assert pairs == sorted(r for r in rows if score[r[0]])
        elif name == "line dedup":
            want = kept_lines(rows)
            assert pairs == sorted((i, want[i, t][2]) for i, t in rows)
        elif name == "simhash near-dedup":
            first = {i for i, _, least in groups(rows) if i == least}
            assert pairs == sorted(r for r in rows if r[0] in first)
        elif name == "source mix":
            mix, texts = source_mix.Mix(before), dict(rows)
            want = naive_mix(mix)
            assert len(pairs) == sum(len(shards) for *_, shards, _ in want)
            taken = {}
            for i, text in pairs:
                assert texts[i].strip().startswith(text.strip())
                taken[i] = taken.get(i, 0) + len(text.encode().split())
            assert taken == {i: n for i, _, n, *_ in want if n}
        else:
            model = sentencepiece.SentencePieceProcessor(
                model_file=public_tokenizers.path("piece_bpe_32k.model"))
            assert sorted((r["doc_id"], r["ids"]) for r in got) == sorted(
                (i, model.encode(t)) for i, t in rows)
    assert 0 < seen["quality classifier"] < start.count()
    key = lambda rows_: sorted((r["doc_id"], r["decoded_sha256"]) for r in rows_)
    assert key(corpus_pipeline.run(spark, SF).collect()) == key(got)


def test_pipeline_stages_take_odd_and_no_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        stored(stage(spark, odd_docs, "/root/testdata/sf0.001"), "stage")
        assert stage(spark, no_docs, "/root/testdata/sf0.001").count() == 0, name


def test_line_stage_counts_characters_anew(spark, odd_docs):
    rows = corpus_pipeline.fresh_lines(spark, odd_docs, "").collect()
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows)


def test_every_operator_has_its_query():
    assert [n.split("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert ORACLE.keys() <= QUERIES.keys()
