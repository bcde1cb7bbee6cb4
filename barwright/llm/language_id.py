"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text, lower-cased, is the average of the embeddings of its runs of 2, 3 and 4 bytes, hashed to
``BUCKETS`` rows. A linear layer and a softmax give the languages. Both are trained by stochastic
gradient descent in numpy on the driver, on a sample of documents bounded in rows and bytes. Being
linear, embeddings and layer are multiplied once, so reading a text adds up a row of logits per run.

Calibration: a temperature fits the probabilities on documents set aside, and ``accepted`` says
whether the score is above the threshold that would have rejected the wrong ones there best.

Learning uses texts with a lang whose crc32(doc_id) mod 3 is not 1. Rows are counted by lang first,
and of more than ``SAMPLE`` about that many are taken by a hash of id and text, as many of one lang as
of another: all of the rare ones, and never under about ``LEAST`` of a lang that has them, so every
lang is learnt at any size. A quarter of each lang's rows is set aside; there a row counts for the
rows of its lang that it stands for, so that scores hold for the table. Of each row up to
``SAMPLE_BYTES`` are learnt, from a place that a hash chooses and in short examples; predictions read
whole texts. Lang, source and doc_id are no input of a prediction. lang_pred is a
learned lang, or "und" with score 0 where the text is null or has no letter, or where nothing could
be learnt. Repeated rows give repeated results, a null doc_id stays null, other columns are ignored,
an empty table gives an empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import learns, pieces, sample_hash

BUCKETS = 2**15
DIMENSIONS = 16
GRAMS = (2, 3, 4)
SAMPLE, SAMPLE_BYTES, EXAMPLE = 3000, 1200, 300
# Rows of a language that are learnt, if it has them, however many languages there are.
LEAST = 200
EPOCHS, RATE, BATCH = 3, 1.0, 16
SEED = 41
# Bytes that are read at once.
AT_ONCE = 1 << 20
LETTER = re.compile(r"[^\W\d_]")


def buckets(data: np.ndarray) -> list[np.ndarray]:
    """For each length of run the buckets of all runs of ``data``."""
    out, wide = [], data.astype(np.uint32)
    for n in GRAMS:
        if len(wide) < n:
            out.append(np.zeros(0, np.int64))
            continue
        mixed = np.full(len(wide) - n + 1, n, np.uint32)
        for k in range(n):
            mixed = (mixed ^ wide[k:len(wide) - n + 1 + k]) * np.uint32(0x01000193)
        mixed ^= mixed >> np.uint32(15)
        out.append((mixed * np.uint32(0x9E3779B1) >> np.uint32(17)).astype(np.int64))
    return out


def letters_of(text: str) -> np.ndarray:
    return np.frombuffer(f" {text.lower()} ".encode(), np.uint8)


class Model:
    """Languages, logits per bucket, temperature and threshold."""

    def __init__(self, languages: list[str]):
        self.languages = languages
        self.logits = np.zeros((BUCKETS, max(1, len(languages))), np.float32)
        self.temperature, self.threshold = 1.0, 0.0

    def averages(self, text: str) -> np.ndarray:
        data, total, runs = letters_of(text), np.zeros(self.logits.shape[1]), 0
        for at in range(0, len(data), AT_ONCE):
            # Runs that begin in this part; they may end in the next.
            part = data[at:at + AT_ONCE + max(GRAMS) - 1]
            for n, found in zip(GRAMS, buckets(part)):
                found = found[:AT_ONCE]
                runs += len(found)
                counts = np.bincount(found, minlength=BUCKETS) if len(found) > BUCKETS else None
                total += (self.logits[found].sum(0, dtype=np.float64) if counts is None
                          else counts @ self.logits)
        return total / max(1, runs)

    def chances(self, averages: np.ndarray) -> np.ndarray:
        z = averages * self.temperature
        z = np.exp(z - z.max(-1, keepdims=True))
        return z / z.sum(-1, keepdims=True)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not self.languages or not LETTER.search(text):
            return "und", 0.0
        chances = self.chances(self.averages(text))
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def train(texts: list[str], langs: list[str], totals: dict[str, int] | None = None) -> Model:
    """Stochastic gradient descent on three quarters of each language's texts, calibration on the
    rest. ``totals`` has how many rows of each language there are, if not those given."""
    model = Model(sorted({*langs}))
    if not model.languages:
        return model
    number = {lang: i for i, lang in enumerate(model.languages)}
    labels = np.array([number[x] for x in langs])
    rng = np.random.default_rng(SEED)
    order = rng.permutation(len(texts))
    each = [order[labels[order] == label] for label in range(len(model.languages))]
    aside = np.concatenate([own[:len(own) // 4] for own in each])
    used = np.concatenate([own[len(own) // 4:] for own in each])
    # Short examples, so that a step does not average a whole text away.
    examples = [(np.concatenate(buckets(part)), labels[i]) for i in used
                for data in [letters_of(texts[i])[:SAMPLE_BYTES]]
                for at in range(0, len(data), EXAMPLE) if len(part := data[at:at + EXAMPLE]) > 8]
    table = rng.uniform(-1, 1, (BUCKETS, DIMENSIONS)) / DIMENSIONS
    layer = rng.uniform(-1, 1, (DIMENSIONS, len(model.languages)))
    for epoch in range(EPOCHS):
        rate, mixed = RATE * (1 - epoch / EPOCHS), rng.permutation(len(examples))
        for at in range(0, len(mixed), BATCH):
            rows = [examples[i] for i in mixed[at:at + BATCH]]
            flat = np.concatenate([grams for grams, _ in rows])
            sizes = np.array([len(grams) for grams, _ in rows])
            means = np.add.reduceat(table[flat], np.cumsum(sizes) - sizes) / sizes[:, None]
            z = means @ layer
            z = np.exp(z - z.max(1, keepdims=True))
            wrong = z / z.sum(1, keepdims=True)
            wrong[np.arange(len(rows)), [label for _, label in rows]] -= 1
            step = rate * (wrong @ layer.T) / sizes[:, None]
            layer -= rate / len(rows) * means.T @ wrong
            np.subtract.at(table, flat, np.repeat(step, sizes, 0))
    model.logits = (table @ layer).astype(np.float32)
    given = np.bincount(labels, minlength=len(model.languages))
    stands = np.array([(totals or {}).get(x, n) / n for x, n in zip(model.languages, given)])
    return calibrate(model, [texts[i] for i in aside], labels[aside], stands[labels[aside]])


def calibrate(model: Model, texts: list[str], labels: np.ndarray, stands: np.ndarray) -> Model:
    """Temperature and threshold from texts that count for ``stands`` rows each."""
    kept = [i for i, t in enumerate(texts) if LETTER.search(t)]
    if not kept:
        return model
    averages = np.array([model.averages(texts[i]) for i in kept])
    labels, stands = labels[kept], stands[kept]

    def loss(temperature):
        model.temperature = temperature
        chances = model.chances(averages)[np.arange(len(labels)), labels]
        return -(np.log(np.maximum(chances, 1e-12)) * stands).sum() / stands.sum()

    model.temperature = min((float(t) for t in np.geomspace(0.1, 100, 61)), key=loss)
    chances = model.chances(averages)
    right = chances.argmax(1) == labels
    scores = chances.max(1)
    # Rejecting is worth it up to the score where most of what is rejected was wrong.
    cuts = np.unique(np.concatenate([[0.0], scores]))
    wrong = np.where(right, -stands, stands)
    gain = [wrong[scores < c].sum() for c in cuts]
    model.threshold = float(cuts[int(np.argmax(gain))])
    return model


def fair_share(counts: list[int], sample: int) -> int:
    """How many rows a language may give so that all together give ``sample``; LEAST at least."""
    left = sample
    for n, count in enumerate(sorted(counts)):
        share = left // (len(counts) - n)
        if count > share:
            return max(LEAST, share)
        left -= count
    return max(LEAST, *counts, 0)


def learnt(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the documents that may be learnt from."""
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).where(
        F.col("text").isNotNull() & F.col("lang").isNotNull() & learns())
    # Of a long text a stretch anywhere in it, since many may begin alike.
    places = F.greatest(F.char_length("text") - SAMPLE_BYTES + 1, F.lit(1))
    begin = F.pmod(F.xxhash64(F.lit("stretch"), "doc_id", "text"), places).cast("int") + 1
    # A row per language.
    counts = {r["lang"]: r["count"] for r in known.groupBy("lang").count().collect()}
    share = fair_share([*counts.values()], sample)
    # From Arrow Spark knows how small it is, and shuffles no texts for the join.
    bounds = docs.sparkSession.createDataFrame(pa.table({
        "of": pa.array([*counts], pa.string()),
        "bound": pa.array([min(2**63 - 1, share * 2**63 // n) for n in counts.values()],
                          pa.int64())}))
    chosen = known.join(bounds, F.col("lang") == F.col("of")).where(
        sample_hash("doc_id", "text") <= F.col("bound"))
    rows = chosen.select(
        "doc_id", "lang", F.substring("text", begin, F.lit(SAMPLE_BYTES)).alias("text")).toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending"), ("lang", "ascending")])
    return train(rows.column("text").to_pylist(), rows.column("lang").to_pylist(), counts)


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score and accepted of every row."""
    def run(batches):
        for batch in pieces(batches):
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([lang for lang, _ in found], pa.string()),
                pa.array([score for _, score in found], pa.float64()),
                pa.array([lang != "und" and score >= model.threshold for lang, score in found],
                         pa.bool_()),
            ], ["doc_id", "lang_pred", "score", "accepted"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, accepted boolean"
                           ).select("doc_id", (~learns()).alias("held_out"), "lang_pred", "score",
                                    "accepted")


def identify(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    return identified(docs, learnt(docs, sample))
