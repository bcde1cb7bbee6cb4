"""Mixing sources to target weights: a multivariate-hypergeometric splitting tree over blocks.

The documents of a source that have words stand in one row, in the order of a hash, and every
``BLOCK_DOCS`` neighbours are a block. A source's target in words is whole passes over all its blocks, and
a last pass over as many permuted blocks as reach it; the document there that would go beyond the
target is cut, and what follows it in its block is left out. So at most one document of a source is cut,
and a source gives its target to the word. Output shards share these quotas of blocks by a tree: a
node's blocks of each source are dealt to its two halves by a multivariate hypergeometric draw with
exact totals, down to single shards of about ``SHARD_BLOCKS``. Each shard finds its own quotas, and where
they begin in each source, by going down from the root; draws are seeded by node, so all shards see
the same tree and none needs the others. The blocks of a pass are permuted by a keyed bijection,
shards take disjoint runs of the permuted row, and each shard shuffles the documents that it took: a
document's ``shard`` and ``place`` say where the mix has it. Every draw depends on the seed and
numbers alone, so reruns agree.

Size is the number of words between ASCII white space, 0 for null. Null is a source of its own, the
last in order. Repeated rows count each; rows are put in row by a hash of (doc_id, text). Sources without
words have target 0. Only doc_id, text and source are read; an empty table gives an empty result.
The driver holds a few numbers per source, no documents, and each shard's draws go over all sources: they
may be some hundred thousand. A source may hold any share of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.common import SPACES, pieces, same, stored, text_key

WEIGHTS = (5, 2, 1)
MOST = 3.0
BLOCK_DOCS = 4
SHARD_BLOCKS = 1024
# Rows that are numbered together.
BUCKET = 4096
SEED = 17
# Numpy draws from urns of fewer balls only.
URN = 10**9


def shared_targets(sizes: list[int], weights: list[float], most: float = MOST) -> list[float]:
    """Shares of the total by weight, none above ``most`` times its size; what is above goes to
    the others by weight, until none is."""
    targets, left = [0.0] * len(sizes), float(sum(sizes))
    open_ = [i for i, size in enumerate(sizes) if size]
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if weights[i] * unit > most * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = weights[i] * unit
            break
        for i in full:
            targets[i] = most * sizes[i]
            left -= targets[i]
        open_ = [i for i in open_ if i not in set(full)]
    return targets


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int, urn: int = URN) -> int:
    """How many of ``draws`` balls out of an urn are good ones, whatever their number.

    Give every ball a random number; the drawn ones are those with the smallest. The middle number of
    the larger colour has a beta distribution, and how many of the other colour are below it a binomial
    one: either all below are drawn, or the draw is among them. That halves the larger colour each time.
    """
    found = 0
    while good + bad >= urn:
        more, fewer = max(good, bad), min(good, bad)
        i = (more + 1) // 2
        below = int(rng.binomial(fewer, rng.beta(i, more + 1 - i)))
        if i + below <= draws:
            draws -= i + below
            found += i if good >= bad else below
            more, fewer = more - i, fewer - below
        else:
            more, fewer = i - 1, below
        good, bad = (more, fewer) if good >= bad else (fewer, more)
    return found + int(rng.hypergeometric(good, bad, draws))


def dealt(rng: np.random.Generator, counts: list[int], draws: int) -> list[int]:
    """How many of ``draws`` balls out of an urn of several colours have each."""
    left, out = sum(counts), []
    for count in counts:
        left -= count
        out.append(hypergeometric(rng, count, left, draws) if draws else 0)
        draws -= out[-1]
    return out


class Plan:
    """Sources in order with their sizes, targets, passes, blocks and quotas.

    ``sizes`` has the words of each source and the number of its documents that have any.
    """

    def __init__(self, sizes: dict[str | None, tuple[int, int]], weights=WEIGHTS, most: float = MOST,
                 block_docs: int = BLOCK_DOCS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED):
        self.names = sorted(sizes, key=lambda s: (s is None, s))
        self.sizes = [sizes[s][0] for s in self.names]
        self.targets = shared_targets(
            self.sizes, [weights[i % len(weights)] for i in range(len(self.names))], most)
        self.block_docs, self.shard_blocks, self.seed = block_docs, shard_blocks, seed
        self.blocks = [ceil(sizes[s][1] / block_docs) for s in self.names]
        goals = [min(round(target), int(most * size))
                 for target, size in zip(self.targets, self.sizes)]
        # Whole passes, and words of the last one.
        self.passes = [goal // size if size else 0 for goal, size in zip(goals, self.sizes)]
        self.rests = [goal - n * size for goal, n, size in zip(goals, self.passes, self.sizes)]
        self.settle({})

    def settle(self, last: dict[int, int]) -> None:
        """Quotas from the number of blocks that each source's last pass needs for its words."""
        self.quotas = [n * blocks + last.get(i, 0)
                       for i, (n, blocks) in enumerate(zip(self.passes, self.blocks))]
        self.shards = max(1, ceil(sum(self.quotas) / self.shard_blocks))

    def shard(self, number: int) -> tuple[list[int], list[int]]:
        """First block and number of blocks of each source in one shard."""
        low, high = 0, self.shards
        first, counts = [0] * len(self.quotas), list(self.quotas)
        while high - low > 1:
            middle = (low + high) // 2
            draws = sum(counts) * (middle - low) // (high - low)
            left = dealt(np.random.default_rng([self.seed, low, high]), counts, draws)
            if number < middle:
                high, counts = middle, left
            else:
                low, first = middle, [a + b for a, b in zip(first, left)]
                counts = [a - b for a, b in zip(counts, left)]
        return first, counts

    def permuted(self, source: int, turn: int, at: np.ndarray) -> np.ndarray:
        """Blocks at places ``at`` of a pass: a keyed bijection of the source's blocks.

        Four Feistel rounds over the next even number of bits; results beyond the blocks go through
        again until they fall inside.
        """
        return self._moved(source, turn, at, False)

    def places(self, source: int, turn: int, blocks: np.ndarray) -> np.ndarray:
        """The places of ``blocks`` in a pass."""
        return self._moved(source, turn, blocks, True)

    def _moved(self, source: int, turn: int, at: np.ndarray, back: bool) -> np.ndarray:
        count = self.blocks[source]
        half = max(1, ((count - 1).bit_length() + 1) // 2)
        mask = np.uint64((1 << half) - 1)
        rounds = np.random.default_rng([self.seed, source, turn, 1]).integers(
            1, 2**63, 4, dtype=np.uint64) | np.uint64(1)

        def mixed(word, key):
            word = (word + key) * np.uint64(0x9E3779B97F4A7C15)
            word ^= word >> np.uint64(29)
            return (word * key >> np.uint64(17)) & mask

        out, todo = at.astype(np.uint64), np.ones(len(at), bool)
        while todo.any():
            left, right = out[todo] >> np.uint64(half), out[todo] & mask
            for key in rounds[::-1] if back else rounds:
                left, right = (right ^ mixed(left, key), left) if back else (
                    right, left ^ mixed(right, key))
            out[todo] = left << np.uint64(half) | right
            todo = out >= count
        return out.astype(np.int64)

    def placed(self, number: int) -> pd.DataFrame:
        """A shard's blocks: shard, source, turn, block and the places of its documents in the
        shuffled shard (the last block of a source may have fewer documents than places)."""
        first, counts = self.shard(number)
        parts = []
        for source in np.flatnonzero(counts).tolist():
            at = np.arange(first[source], first[source] + counts[source])
            turn, place = at // self.blocks[source], at % self.blocks[source]
            block = np.empty(len(at), np.int64)
            for t in np.unique(turn):
                block[turn == t] = self.permuted(source, int(t), place[turn == t])
            parts.append(pd.DataFrame({"source": source, "turn": turn, "block": block}))
        rows = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(
            {"source": [], "turn": [], "block": []}, dtype="int64")
        rows.insert(0, "shard", number)
        shuffled = np.random.default_rng([self.seed, number, 2]).permutation(
            len(rows) * self.block_docs).reshape(len(rows), self.block_docs)
        return rows.astype("int64").assign(places=pd.Series([*shuffled], dtype=object))


def placements(spark, plan: Plan) -> DataFrame:
    """shard, source (its number), turn, block and places of every block that the mix takes."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for number in frame["id"]:
                yield plan.placed(int(number))

    # Shards are a few thousand blocks each; the scheduler deals them to all cores in even runs.
    return spark.range(plan.shards).mapInPandas(
        run, "shard long, source long, turn long, block long, places array<long>")


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, source and size of every row."""
    def run(batches):
        for batch in pieces(batches):
            sizes = [len(t.encode().split()) if t else 0 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "text_key", "source")),
                 pa.array(sizes, pa.int64())], ["doc_id", "text_key", "source", "size"])

    rows = docs.select("doc_id", text_key().alias("text_key"),
                       docs["source"].cast("string").alias("source"),
                       docs["text"].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, source string, size long")


def numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with ``rank``: the documents of the source before this one in its row.

    Rows are dealt to buckets of even size by a hash, whatever their source. Counts by bucket and
    source are added up over the buckets, and rows inside a bucket.
    """
    buckets = max(1, ceil(rows.count() / BUCKET))
    spread = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_key", F.lit("mix")),
                                              F.lit(buckets)))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = spread.groupBy("source", "bucket").agg(F.count("*").alias("docs")).select(
        F.col("source").alias("of_source"), F.col("bucket").alias("of_bucket"),
        F.coalesce(F.sum("docs").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("bucket", "source").orderBy(
        F.xxhash64("doc_id", "text_key", F.lit("row")), "doc_id", "text_key")
    counts = spread.repartition("bucket").withColumn("inside", F.row_number().over(inside) - 1)
    return counts.join(offsets, same(F.col("source"), F.col("of_source"),
                                     F.col("bucket"), F.col("of_bucket"))).withColumn(
        "rank", F.col("offset") + F.col("inside")).drop(
        "of_source", "of_bucket", "bucket", "inside", "offset")


def last_pass(rows: DataFrame, plan: Plan) -> DataFrame:
    """``rows`` with ``place``, that of their block in the last pass of their source, and ``last``,
    how many of their first words that pass takes.

    Words are added up over runs of BUCKET places, and rows inside a run.
    """
    @F.pandas_udf("long")
    def place_of(number: pd.Series, block: pd.Series) -> pd.Series:
        out = np.zeros(len(block), np.int64)
        sources, blocks = number.to_numpy(), block.to_numpy()
        for source in np.unique(sources):
            own = sources == source
            out[own] = plan.places(int(source), plan.passes[source], blocks[own])
        return pd.Series(out)

    placed = rows.withColumn("place", place_of("number", "block")).withColumn(
        "run", F.floor(F.col("place") / BUCKET))
    before = Window.partitionBy("of_number").orderBy("of_run").rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = placed.groupBy(F.col("number").alias("of_number"), F.col("run").alias("of_run")).agg(
        F.sum("size").alias("words_here")).withColumn(
        "offset", F.coalesce(F.sum("words_here").over(before), F.lit(0)))
    inside = Window.partitionBy("number", "run").orderBy("place", "rank").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = placed.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    open_ = F.col("rest") - F.col("offset") - F.col("inside")
    return sums.join(offsets, (F.col("number") == F.col("of_number")) & (
        F.col("run") == F.col("of_run"))).withColumn(
        "last", F.greatest(F.expr("0L"), F.least(F.col("size"), open_))).drop(
        "of_number", "of_run", "run", "words_here", "offset", "inside")


class Mix:
    """A mix of documents: the plan, the documents' places in their sources, the blocks taken."""

    def __init__(self, docs: DataFrame, weights=WEIGHTS, most: float = MOST,
                 block_docs: int = BLOCK_DOCS, shard_blocks: int = SHARD_BLOCKS,
                 seed: int = SEED):
        spark = docs.sparkSession
        self.rows = rows = stored(measured(docs), "mix-sizes")
        sizes = {r["source"]: (r["size"], r["docs"]) for r in rows.groupBy("source").agg(
            F.sum("size").alias("size"), F.count_if(F.col("size") > 0).alias("docs")).collect()}
        self.plan = plan = Plan(sizes, weights, most, block_docs, shard_blocks, seed)
        self.sources = spark.createDataFrame(
            [*zip(range(len(plan.names)), plan.names, plan.sizes, plan.targets, plan.passes,
                  plan.rests)],
            "number long, name string, source_size long, target double, passes long, rest long")
        ranked = stored(self._with_source(numbered(rows.where("size > 0"))).withColumn(
            "block", F.floor(F.col("rank") / block_docs)), "mix-rows")
        self.ranked = stored(last_pass(ranked, plan), "mix-last")
        plan.settle({r["number"]: r["last"] for r in self.ranked.where("last > 0").groupBy(
            "number").agg((F.max("place") + 1).alias("last")).collect()})  # a row per source
        self.placements = placements(spark, plan)

    def _with_source(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.sources, F.col("source").eqNullSafe(F.col("name"))).drop("name")

    def passed(self) -> DataFrame:
        """A row for each pass that takes words of a document that has any: turn, shard, place there,
        and gain, the number of its first words that are taken."""
        # Their size is not known before they are made, and Spark's guess would broadcast them.
        blocks = self.placements.hint("merge").select(
            F.col("source").alias("p_source"), F.col("block").alias("p_block"), "turn", "shard", "places")
        gain = F.when(F.col("turn") < F.col("passes"), F.col("size")).otherwise(F.col("last"))
        return self.ranked.drop("place").join(
            blocks, (F.col("number") == F.col("p_source")) & (F.col("block") == F.col("p_block"))
        ).withColumn("gain", gain).where("gain > 0").withColumn("place", F.get(
            "places", F.col("rank") % self.plan.block_docs)).drop("p_source", "p_block", "places")

    def taken(self) -> DataFrame:
        """doc_id, size, source_size, target and taken (words with repeats) of every row, and shards and
        places: where each pass that takes words of it has put it."""
        turns = F.sort_array(F.collect_list(F.struct("turn", "shard", "place")))
        gains = self.passed().groupBy(F.col("number").alias("of"), F.col("rank").alias("at")).agg(
            F.sum("gain").alias("gain"), turns.alias("turns"))
        some = self.ranked.join(gains, (F.col("number") == F.col("of")) & (F.col("rank") == F.col("at")),
                                "left").select(
            "doc_id", "size", "source_size", "target", F.coalesce("gain", F.expr("0L")).alias("taken"),
            *[F.coalesce(f"turns.{c}", F.array().cast("array<long>")).alias(f"{c}s")
              for c in ("shard", "place")])
        none = self._with_source(self.rows.where("size = 0")).select(
            "doc_id", "size", "source_size", "target", F.expr("0L").alias("taken"),
            *[F.array().cast("array<long>").alias(c) for c in ("shards", "places")])
        return some.unionByName(none)

    def texts(self, docs: DataFrame) -> DataFrame:
        """Rows of ``docs`` as the mix takes them, shard by shard in the order of their places: a row for
        each pass that takes any of its words, with the text cut after the words taken, and n_chars, if
        there, counted anew. A row whose words are all taken keeps its text as it is; rows without
        words are not taken."""
        key = ["doc_id", "text_key", "source"]
        # Rows with the same key and text are numbered on both sides; every one has a rank.
        number = F.dense_rank().over(Window.partitionBy(*key).orderBy("rank"))
        taken = self.passed().withColumn("copy", number).groupBy(*key).agg(F.collect_list(F.struct(
            "copy", (F.col("gain") == F.col("size")).alias("whole"), F.col("gain").cast("int").alias("gain"),
            "shard", "place")).alias("taken"))
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")).select(
            "row", F.col("row.doc_id").alias("id"), text_key(F.col("row.text")).alias("key"),
            F.col("row.source").cast("string").alias("of"))
        joined = rows.join(taken, same(F.col("id"), F.col("doc_id"), F.col("key"),
                                       F.col("text_key"), F.col("of"), F.col("source")))
        each = joined.withColumn("n", F.row_number().over(
            Window.partitionBy("id", "key", "of").orderBy("key"))).select(
            "row", F.explode(F.filter("taken", lambda t: t["copy"] == F.col("n"))).alias("cut"))
        text = F.when(F.col("cut.whole"), F.col("row.text")).otherwise(
            first_words(F.col("row.text"), F.col("cut.gain")))
        mixed = each.withColumn("new", text).repartition("cut.shard").sortWithinPartitions(
            "cut.shard", "cut.place")
        changed = {"text": F.col("new"), "n_chars": F.char_length("new").cast("long")}
        return mixed.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` of more words of a text, as they stand."""
    begun = F.ltrim(text, F.lit(SPACES))
    # A split in n + 1 parts leaves the rest of the text as the last one.
    rest = F.element_at(F.split(begun, f"[{SPACES}]+", n + 1), -1)
    return F.rtrim(F.substring(begun, F.lit(1), F.char_length(begun) - F.char_length(rest)), F.lit(SPACES))


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target, taken, shards and places of every row."""
    return Mix(docs, **options).taken()


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The documents that the mix takes, as ``Mix.texts`` has them."""
    return Mix(docs, **options).texts(docs)
