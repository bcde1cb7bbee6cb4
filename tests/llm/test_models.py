"""The learnt models against plain versions: ridge by one dense system, isotonic steps by their formula,
softmax over averaged runs of bytes."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow.parquet as pq

from barwright.llm import language_id, quality
from barwright.llm.common import table

BIG = "/root/testdata/sf0.01"


def test_ridge_weights_equal_one_dense_system(spark):
    docs, labels = (pq.read_table(f"{BIG}/{name}.parquet").to_pylist() for name in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs}
    fold = lambda i: zlib.crc32(str(i).encode()) % 3
    told = [(quality.statistics(texts[r["doc_id"]]), r["quality"], fold(r["doc_id"])) for r in labels
            if r["doc_id"] in texts and r["quality"] in (0, 1) and fold(r["doc_id"]) != 1]
    x = np.array([s for s, _, _ in told])
    plain = quality.Model(x.mean(0), x.std(0))
    own = np.array([f for *_, f in told]) == 0
    z, y = plain.features(x[own]), np.array([q for _, q, _ in told])[own] - 0.5
    ridge = np.diag([quality.RIDGE * own.sum() / quality.FEATURES] * quality.FEATURES + [0.0])
    plain.weights = np.linalg.solve(z.T @ z + ridge + 1e-9 * np.eye(len(ridge)), z.T @ y)
    model = quality.fit(quality.measured(table(spark, BIG, "documents")), table(spark, BIG, "labels"))
    assert np.allclose(model.mean, plain.mean) and np.allclose(model.spread, plain.spread)
    assert np.allclose(model.raw(x), plain.raw(x), atol=1e-6)


def test_rising_steps_equal_their_formula():
    draw = np.random.default_rng(3)
    for n in (1, 2, 7, 30):
        values, weights = draw.random(n), draw.integers(1, 9, n).astype(float)
        mean = lambda a, b: (values[a:b + 1] * weights[a:b + 1]).sum() / weights[a:b + 1].sum()
        want = [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]
        assert np.allclose(quality.rising(values, weights), want)


def naive_buckets(text):
    data, found = f" {text.lower()} ".encode(), []
    for n in language_id.GRAMS:
        for at in range(len(data) - n + 1):
            mixed = n
            for byte in data[at:at + n]:
                mixed = (mixed ^ byte) * 0x01000193 % 2**32
            mixed ^= mixed >> 15
            found.append(mixed * 0x9E3779B1 % 2**32 >> 17)
    return found


def test_predictions_equal_a_plain_softmax(sf_docs, monkeypatch):
    texts = [t for t in sf_docs.values() if 20 < len(t) < 3000][:60]
    langs = ["xx" if n % 3 else "yy" for n in range(len(texts))]
    model = language_id.train(texts, langs)
    for at_once in (language_id.AT_ONCE, 64):
        monkeypatch.setattr(language_id, "AT_ONCE", at_once)
        for text in [*texts[:12], "É", "ab"]:
            found = naive_buckets(text)
            sums = [sum(float(model.logits[b][k]) for b in found) / len(found) * model.temperature
                    for k in range(2)]
            chances = [math.exp(s - max(sums)) for s in sums]
            best = max(range(2), key=chances.__getitem__)
            lang, score = model.predict(text)
            assert lang == model.languages[best]
            assert abs(score - chances[best] / sum(chances)) < 1e-6


def test_a_few_texts_are_learnt():
    texts = ["der hund und die katze", "the dog and the cat", "le chien et le chat"] * 20
    langs = ["de", "en", "fr"] * 20
    model = language_id.train(texts, langs)
    assert [model.predict(t)[0] for t in texts[:3]] == langs[:3]
    assert model.predict("die katze und der hund")[0] == "de" and model.predict("123 !")[0] == "und"
