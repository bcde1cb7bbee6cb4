"""Exact top-k inner products over vectors in descending length.

Vectors are rotated onto the singular directions of all of them, so that the first coordinates carry
most of a product. Candidates are ranged by length, longest first, and each range meets the queries
in blocks. There a query holds the best scores so far; it starts with what the longest vectors of
all gave. For a chunk of candidates three bounds follow each other:

* length times length (Cauchy-Schwarz): when the longest left cannot reach any query, the rest of
  the range is done,
* the product of the first coordinates plus the lengths of the rest multiplied,
* the product itself, in whole numbers.

A bound prunes only what is strictly less than the k-th score, so ties are kept, and it allows for
the rounding of the rotation. Ties in the result go to the smaller vec_id.

Vectors that are null or hold null or non-finite components take no part, nor do rows with a null
vec_id. An empty vector scores 0. Vectors of different lengths are compared as if filled up with zeros.
Repeated rows of a vector count once; of different vectors with one vec_id each is a candidate, and
the largest in array order is the query. Where a product could reach 2^53, whole numbers of any size
take the place of doubles; a score beyond 64 bits fails the job. Other columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.common import stored

SCALE = 256
TOP = 5
EVERY = 50
# Queries of a block, candidates of a range, and candidates scored at once.
QUERY_BLOCK, RANGE, CHUNK = 4096, 8192, 1024
# The longest vectors, which every query meets first.
SEEDS = 2048


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v (whole numbers as longs) and norm of every vector that takes part."""
    x = F.col("embedding").cast("array<double>")
    fit = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))))
    found = rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("embedding")).where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fit).select(
        "vec_id", v.alias("v")).distinct()
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda n, c: n + c.cast("double") * c))
    return found.withColumn("norm", norm)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix of doubles, short rows filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy().astype(np.float64)
    if (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width))
    out[np.repeat(np.arange(len(sizes)), sizes),
        np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def numbers_of(column: pa.Array) -> list[list[int]]:
    return column.to_pylist()


def exact_products(left: list[list[int]], right: list[list[int]]) -> np.ndarray:
    """Inner products in whole numbers of any size; what one vector is shorter counts as zeros."""
    out = np.array([[sum(map(mul, a, b)) for b in right] for a in left], object).reshape(
        len(left), len(right))
    if out.size and max(abs(out.min()), abs(out.max())) >= 2**63:
        raise ArithmeticError("an inner product is beyond 64 bits")
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """The right singular vectors of all vectors, by their summed products of coordinates."""
    def products(batches):
        total = np.zeros((width, width))
        for batch in batches:
            m = matrix(batch.column("v"), width)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total))], ["i", "row"])

    parts = vectors.select("v").mapInArrow(products, "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(
        F.sum("x").alias("x")).collect()  # a number per pair of coordinates
    gram = np.zeros((width, width))
    for r in sums:
        gram[r["i"], r["j"]] = r["x"]
    values, directions = np.linalg.eigh((gram + gram.T) / 2)
    return directions[:, np.argsort(-values)]


class Search:
    """Bounds and scores of queries against chunks of candidates."""

    def __init__(self, turn: np.ndarray, top: int, ids: np.ndarray, queries: np.ndarray,
                 least: np.ndarray, numbers: list[list[int]]):
        self.turn, self.top, self.ids, self.queries, self.numbers = turn, top, ids, queries, numbers
        self.head = max(1, turn.shape[1] // 4)
        self.turned = queries @ turn
        self.norms = np.linalg.norm(queries, axis=1)
        self.rests = np.linalg.norm(self.turned[:, self.head:], axis=1)
        self.least = least.astype(np.float64).copy()
        self.found: list[list[tuple[int, int]]] = [[] for _ in ids]

    def meet(self, ids: np.ndarray, vectors: np.ndarray, norms: np.ndarray, column: pa.Array) -> bool:
        """Scores a chunk in descending length; False if no query can gain from it or later ones."""
        slack = 1e-9 * self.norms * (norms[0] if len(norms) else 0.0) + 1e-6
        open_ = np.flatnonzero(self.norms * norms[0] + slack >= self.least)
        if not len(open_):
            return False
        turned = vectors @ self.turn
        rests = np.linalg.norm(turned[:, self.head:], axis=1)
        bound = self.turned[open_, :self.head] @ turned[:, :self.head].T
        bound += self.rests[open_, None] * rests
        hopeful = bound + slack[open_, None] >= self.least[open_, None]
        live = open_[hopeful.any(1)]
        columns = np.flatnonzero(hopeful.any(0))
        if len(live) and len(columns):
            self._score(live, ids[columns], vectors[columns], norms[0], column.take(pa.array(columns)))
        return True

    def _score(self, live: np.ndarray, ids: np.ndarray, vectors: np.ndarray, longest: float,
               column: pa.Array) -> None:
        if self.norms.max(initial=0.0) * longest < 2**52:
            scores = self.queries[live] @ vectors.T  # whole numbers below 2^53: exact
        else:
            scores = exact_products([self.numbers[q] for q in live.tolist()], numbers_of(column))
        good = (scores >= self.least[live, None]) & (ids != self.ids[live, None])
        for row in np.flatnonzero(good.any(1)):
            q, at = live[row], np.flatnonzero(good[row])
            best = sorted(at.tolist(), key=lambda c: (-scores[row, c], ids[c]))[:self.top] \
                if scores.dtype == object else at[np.lexsort((ids[at], -scores[row, at]))[:self.top]]
            merged = self.found[q] + [(-int(scores[row, c]), int(ids[c])) for c in best]
            self.found[q] = sorted(merged)[:self.top]
            if len(self.found[q]) == self.top:
                # Rounded down where it is no double, so that ties stay.
                self.least[q] = max(self.least[q], np.nextafter(-self.found[q][-1][0], -np.inf)
                                    if abs(self.found[q][-1][0]) > 2**53 else -self.found[q][-1][0])

    def results(self) -> Iterator[tuple[int, int, int]]:
        for q, found in zip(self.ids.tolist(), self.found):
            for score, other in found:
                yield q, other, -score


def top_products(rows: DataFrame, every: int = EVERY, top: int = TOP, scale: int = SCALE,
                 query_block: int = QUERY_BLOCK, range_rows: int = RANGE) -> DataFrame:
    """query_id, rank, vec_id and score: the ``top`` largest inner products of each query, a row
    whose vec_id is divisible by ``every``, with all rows but its own."""
    result = "query_id long, rank int, vec_id long, score long"
    spark = rows.sparkSession
    all_ = stored(whole_vectors(rows, scale), "vectors")
    count, width = all_.agg(F.count("*"), F.max(F.size("v"))).first()
    if not count:
        return spark.createDataFrame([], result)
    turn = rotation(all_, width := max(1, width))
    ranges = stored(all_.repartitionByRange(
        max(1, ceil(count / range_rows)), F.desc("norm"), F.col("vec_id"), F.col("v")).withColumn(
        "part", F.spark_partition_id()), "vector-ranges")
    longest = ranges.orderBy(F.desc("norm"), "vec_id", "v").limit(SEEDS).toArrow()
    longest = longest.combine_chunks().to_batches()[0]
    seeds = (longest.column("vec_id").to_numpy(), matrix(longest.column("v"), width),
             longest.column("norm").to_numpy().max(), longest.column("v"))

    asking = ranges.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(
        F.max("v").alias("v"))

    def start(batches):
        for batch in batches:
            ids, vectors = batch.column("vec_id").to_numpy(), matrix(batch.column("v"), width)
            least = np.full(len(ids), -np.inf)
            for at in range(0, len(ids), 512):
                cut = slice(at, at + 512)
                first = Search(turn, top, ids[cut], vectors[cut], least[cut],
                               numbers_of(batch.column("v").slice(at, 512)))
                first._score(np.arange(len(ids[cut])), *seeds)
                least[cut] = first.least
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.linalg.norm(vectors, axis=1)), pa.array(least)],
                ["vec_id", "v", "norm", "least"])

    queries = stored(asking.mapInArrow(
        start, "vec_id long, v array<long>, norm double, least double"), "queries")
    blocks = max(1, ceil(queries.count() / query_block))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    # A block meets a range only if its easiest query can still gain from the longest vector there.
    reach = queries.groupBy("block").agg(
        F.min(F.when(F.col("norm") > 0, F.col("least") / F.col("norm"))
              .otherwise(F.lit(float("-inf")))).alias("floor"))
    longest_of = ranges.groupBy("part").agg(F.max("norm").alias("longest"))
    meets = reach.join(longest_of.withColumn("block", F.explode(F.sequence(
        F.expr("0L"), F.lit(blocks - 1).cast("long")))), "block").where(
        F.col("longest") * (1 + 1e-9) + 1e-6 >= F.col("floor")).select("block", "part")
    meets = stored(meets, "meetings")
    asked = queries.join(meets, "block").select(
        "block", "part", F.lit(0).alias("kind"), "vec_id", "v", "norm", "least")
    offered = ranges.join(meets, "part").select(
        "block", "part", F.lit(1).alias("kind"), "vec_id", "v", "norm",
        F.lit(0.0).alias("least"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, asked_, current, done = None, [], None, False

        def output(s):
            cells = [*zip(*s.results())] if s else []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in cells or ([], [], [])],
                ["query_id", "vec_id", "score"])

        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                keys = np.stack([batch.column(c).to_numpy() for c in ("part", "block", "kind")], 1)
                edges = np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1
                for begin, end in zip([0, *edges], [*edges, len(keys)]):
                    part, block, kind = keys[begin]
                    rows_ = batch.slice(begin, end - begin)
                    if (part, block) != here:
                        if current:
                            yield output(current)
                        here, asked_, current, done = (part, block), [], None, False
                    ids = rows_.column("vec_id").to_numpy()
                    if kind == 0:
                        asked_.append((ids, matrix(rows_.column("v"), width),
                                       rows_.column("least").to_numpy(), numbers_of(rows_.column("v"))))
                    elif asked_ and not done:
                        current = current or Search(turn, top, *(
                            np.concatenate([a[i] for a in asked_]) for i in range(3)),
                            [v for a in asked_ for v in a[3]])
                        done = not current.meet(ids, matrix(rows_.column("v"), width),
                                                rows_.column("norm").to_numpy(), rows_.column("v"))
        if current:
            yield output(current)

    order = ["part", "block", "kind", F.desc("norm"), "vec_id"]
    near = asked.unionByName(offered).repartition("part", "block").sortWithinPartitions(
        *order).mapInArrow(search, "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score")


TOP_PRODUCTS_SQL = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER)
    AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
