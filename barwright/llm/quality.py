"""Quality classifier: random Fourier features, ridge regression and isotonic calibration.

Of every text some statistics are taken (lengths, kinds of characters, repeated words and lines).
Random Fourier features turn the standardised statistics into coordinates whose products approximate
a Gaussian kernel. Each partition sums its part of the normal equations; the sums give the ridge
weights. Raw scores are put in bins, and pooling neighbouring bins until the share of good labels
rises gives a monotone map to probabilities, linear between the bins.

Learning uses labelled rows whose crc32(doc_id) mod 3 is not 1: those with 0 fit the weights, those
with 2 the calibration. Of more than ``SAMPLE`` such rows about that many are taken by a hash of the
id. Labels other than 0 and 1 are ignored; with repeated labels of one doc_id each counts. Labels,
lang, source and doc_id are no input of a score.

A null text is scored as empty, and empty texts get a score like all others. Without any label to
learn from every score is 0.5. Repeated rows give repeated results, a null doc_id stays null,
other columns are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barwright.llm.common import bounded_sample, learns, pieces, stored

FEATURES = 384
RIDGE = 1e-3
BINS, BIN_ROWS = 200, 25
SAMPLE = 200_000
SEED = 31
# Rows that a partition of the normal equations sums.
ROWS = 4096
CLASSES = ("upper", "lower", "digit", "space", "newline", "stop", "pipe", "mark", "high")


def _classes() -> np.ndarray:
    """The class of each byte of UTF-8."""
    found = np.full(256, CLASSES.index("mark"))
    found[0x80:] = CLASSES.index("high")
    for name, members in (("upper", range(65, 91)), ("lower", range(97, 123)),
                          ("digit", range(48, 58)), ("space", b" \t\r\x0b\x0c"),
                          ("newline", b"\n"), ("stop", b".,;:'-"), ("pipe", b"|")):
        found[[*members]] = CLASSES.index(name)
    return found


BYTE_CLASSES = _classes()


def statistics(text: str) -> list[float]:
    """What the score sees of a text; every value is finite, also for an empty text."""
    data = text.encode()
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size, words, lines = max(1, len(data)), data.split(), data.split(b"\n")
    n = max(1, len(words))
    share = np.bincount(BYTE_CLASSES, counts, len(CLASSES)) / size
    bytes_ = counts[counts > 0] / size
    entropy = float(-(bytes_ * np.log(bytes_)).sum()) if len(data) else 0.0
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    seen = Counter(words)
    common = max(seen.values(), default=0) / n
    full = [x for x in lines if x.strip()]
    ends = Counter(w[-1] for w in words)
    marks = sum(k for b, k in ends.items() if BYTE_CLASSES[b] in (5, 6, 7)) / n
    return [
        np.log1p(len(data)), np.log1p(len(lines)), *share.tolist(), entropy,
        float(lengths.mean()), float(np.log1p(lengths.std())), float(np.log1p(lengths.max())),
        len(seen) / n, common, sum(map(eq, words, words[1:])) / n, marks,
        len({*full}) / max(1, len(full)), np.log1p(len(words)),
    ]


WIDTH = len(statistics(""))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics x of every row."""
    def run(batches):
        for batch in pieces(batches):
            x = [statistics(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    rows = docs.select("doc_id", docs["text"].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, x array<double>")


def array_of(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Model:
    """Standardisation, random features, ridge weights and the calibration of a fit."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.spread = mean, np.where(spread > 1e-9, spread, 1.0)
        # Gaussian kernel whose width is the root of the number of statistics.
        self.turn = rng.normal(size=(WIDTH, FEATURES)) / np.sqrt(WIDTH)
        self.shift = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.bins, self.values = np.array([0.0]), np.array([0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        waves = np.cos(z @ self.turn + self.shift) * np.sqrt(2 / FEATURES)
        return np.hstack([waves, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(x), self.bins, self.values)


def rising(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The nearest rising sequence: neighbours that fall are pooled."""
    pools: list[list[float]] = []
    for value, weight in zip(values.tolist(), weights.tolist()):
        pools.append([value, weight, 1])
        while len(pools) > 1 and pools[-2][0] >= pools[-1][0]:
            value, weight, n = pools.pop()
            last = pools[-1]
            total = last[1] + weight
            last[:] = [(last[0] * last[1] + value * weight) / total, total, last[2] + n]
    return np.repeat([p[0] for p in pools], [p[2] for p in pools])


def fit(stats: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of the labelled rows of ``stats`` that may be learnt from."""
    known = labels.select(F.col("doc_id").alias("doc_id"), F.col("quality").cast("int").alias(
        "quality")).where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & learns())
    rows = stored(bounded_sample(stats.join(known, "doc_id").select("doc_id", "x", "quality"),
                                 sample), "quality-rows")
    at = F.posexplode("x").alias("i", "v")
    count = rows.count()
    if not count:
        return Model(np.zeros(WIDTH), np.ones(WIDTH))
    moments = {r["i"]: r for r in rows.select(at).groupBy("i").agg(
        F.avg("v").alias("mean"), F.stddev_pop("v").alias("spread")).collect()}
    model = Model(*(np.array([moments[i][c] for i in range(WIDTH)]) for c in ("mean", "spread")))
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    parts = max(1, count // ROWS)

    def equations(batches):
        total = np.zeros((FEATURES + 1, FEATURES + 2))
        for batch in batches:
            z = model.features(array_of(batch.column("x")))
            y = batch.column("quality").to_numpy() - 0.5
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total), dtype=np.int32)), pa.array(list(total))], ["i", "row"])

    def added(key, part):
        rows_ = array_of(part.column("row").combine_chunks())
        return pa.table({"i": pa.array([key[0].as_py()], pa.int32()), "row": [rows_.sum(0)]})

    spread = rows.where(fold == 0).select("x", "quality").repartition(parts)
    sums = spread.mapInArrow(equations, "i int, row array<double>").groupBy("i").applyInArrow(
        added, "i int, row array<double>").collect()  # a row per feature
    system = np.zeros((FEATURES + 1, FEATURES + 2))
    for r in sums:
        system[r["i"]] = r["row"]
    n = max(1.0, system[-1, -2])
    left = system[:, :-1] + RIDGE * n * np.diag([1.0 / FEATURES] * FEATURES + [0.0]) \
        + 1e-9 * np.eye(FEATURES + 1)
    model.weights = np.linalg.solve(left, system[:, -1])
    return calibrated(model, rows.where(fold == 2).select("x", "quality"))


def calibrated(model: Model, rows: DataFrame) -> Model:
    """Adds the isotonic map from raw scores to shares of good labels, learnt on ``rows``."""
    def raw(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(model.raw(array_of(batch.column("x")))), batch.column("quality")],
                ["raw", "quality"])

    scored = rows.mapInArrow(raw, "raw double, quality int")
    scored = stored(scored, "quality-raw")
    count = scored.count()
    bins = max(2, min(BINS, count // BIN_ROWS))
    edges = scored.agg(F.percentile_approx("raw", [i / bins for i in range(1, bins)], 10_000)
                       .alias("edges")).first()["edges"]
    if not edges:  # nothing to calibrate on: the raw score, half a label up
        model.bins, model.values = np.array([-0.5, 0.5]), np.array([0.0, 1.0])
        return model
    bounds = F.array(*[F.lit(e) for e in sorted({*edges})])
    bins = scored.withColumn("bin", F.size(F.filter(bounds, lambda e: e < F.col("raw")))).groupBy(
        "bin").agg(F.avg("raw").alias("raw"), F.avg("quality").alias("share"),
                   F.count("*").alias("n")).orderBy("bin").collect()  # at most BINS rows
    weights = np.array([float(b["n"]) for b in bins])
    shares = (np.array([b["share"] for b in bins]) * weights + 0.5) / (weights + 1)
    model.bins, model.values = np.array([b["raw"] for b in bins]), rising(shares, weights)
    return model


def scored(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    stats = stored(measured(docs), "quality-stats")
    model = fit(stats, labels, sample)

    def run(batches):
        for batch in batches:
            score = model.score(array_of(batch.column("x"))) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.mapInArrow(run, f"doc_id {kind}, score double").select(
        "doc_id", (~learns()).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def good_documents(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose text scores 0.5 or more, whole."""
    stats = stored(measured(docs), "quality-stats")
    model = fit(stats, labels, sample)

    def run(batches):
        for batch in pieces(batches):
            texts = batch.column("text").cast(pa.string()).to_pylist()
            x = np.array([statistics(t or "") for t in texts]).reshape(-1, WIDTH)
            yield batch.filter(pa.array(model.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
