"""Filter interaction audit on a stream that takes back what it said.

Five filters judge every text: A under 100 words; B fewer than 80 % distinct words; C more than 10 %
capital letters; D one of ``#$%&*|``; E the text of a smaller doc_id. For every order of the five the
audit tells per part (lang) what each step keeps and removes, and what that overlaps with.

A to D see one text. E depends on the whole table, and the files come one micro-batch after another
(available now): a text's holder is the smallest doc_id seen so far. Keyed state has the holder of
every text with what it failed. When a smaller id arrives, the holder's count is taken back, put in
again as failing E, and the new one takes its place. Each micro-batch so adds signed changes to the
counters of (part, failed filters, labels), in a folder of its own that a repeated micro-batch
overwrites; state and progress are in the checkpoint of the shared folder. The orders
are worked out from the sums of these counters, a few numbers per part.

State is keyed by a shard of the texts' 128-bit hashes, about ``SHARD`` documents each, so that a
micro-batch rewrites small entries. Before the shuffle each task reduces equal texts to its smallest
id and settles the others at once: a text that a third of all rows have is one row a task.

A null text counts as empty, a null lang as part '', a null doc_id as 2^63 - 1, the largest, and it has
no label. Rows with the same id and text are all holders of it, so none of them fails E for the other.
Repeated labels of one id count once; labels other than 1, missing ones included, count as 0.
Other columns may have any name. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import pickle
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from barwright.llm.common import pieces, stored
from barwright.session import path_exists, scratch_dir

FILTERS = "ABCDE"
SHORT, DISTINCT, CAPITALS = 100, 80, 10
MARKS = b"#$%&*|"
UPPER = bytes(range(65, 91))
CONTINUED = bytes(range(0x80, 0xC0))  # bytes of UTF-8 that begin no code point
LATER = 1 << FILTERS.index("E")
GOOD, TOXIC = 1 << len(FILTERS), 2 << len(FILTERS)
LAST_ID = 2**63 - 1
SHARD, HELD = 256, 200_000
# Micro-batches of a whole table, however large it is.
BATCHES = 8
# Salts of rows without an id, which no label has.
SALTS = 1024
CHANGE = "shard long, text binary, doc long, part string, class int, n long"


def failed(text: bytes) -> int:
    """The bits of the filters A to D that a text fails."""
    words = text.split()
    points = len(text.translate(None, CONTINUED))
    capitals = len(text) - len(text.translate(None, UPPER))
    return ((len(words) < SHORT) | (100 * len(set(words)) < DISTINCT * len(words)) << 1
            | (100 * capitals > CAPITALS * points) << 2
            | (len(text.translate(None, MARKS)) < len(text)) << 3)


def judged(docs: DataFrame) -> DataFrame:
    """doc, salt, part, text (its hash) and class (failed filters) of every row."""
    def run(batches):
        for batch in pieces(batches):
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc"), batch.column("salt"), batch.column("part"),
                pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary()),
                pa.array([failed(t) for t in texts], pa.int32())],
                ["doc", "salt", "part", "text", "class"])

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce("doc_id", F.lit(LAST_ID)).cast("long").alias("doc"),
        F.when(F.col("doc_id").isNull(), F.pmod(F.xxhash64(text), F.lit(SALTS)) + 1).otherwise(
            F.expr("0L")).alias("salt"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.cast("binary").alias("text")).mapInArrow(
        run, "doc long, salt long, part string, text binary, class int")


def labels_by_doc(labels: DataFrame) -> DataFrame:
    """doc, salt and the label bits of each doc_id that has any."""
    bit = lambda name, value: F.max(
        F.when(F.col(name).cast("int") == 1, F.lit(value)).otherwise(F.lit(0)))
    return labels.where(F.col("doc_id").isNotNull()).groupBy(
        F.col("doc_id").cast("long").alias("doc"), F.expr("0L").alias("salt")).agg(
        (bit("quality", GOOD) + bit("toxic", TOXIC)).alias("labels")).where("labels > 0")


class Holders(dict):
    """text -> (smallest doc, counts of its (part, class)). ``changes`` has what adding rows does to
    the counters."""

    def add(self, changes: Counter, text: bytes, doc: int, cell: tuple[str, int], n: int) -> None:
        part, kind = cell
        least, cells = self.get(text, (None, None))
        if least is None or doc < least:
            for (old, was), k in (cells or {}).items():
                changes[old, was] -= k
                changes[old, was | LATER] += k
            self[text] = (doc, {cell: n})
            changes[cell] += n
        elif doc == least:
            cells[cell] = cells.get(cell, 0) + n
            changes[cell] += n
        else:
            changes[part, kind | LATER] += n


def reduced(rows: DataFrame, shards: int) -> DataFrame:
    """The smallest id of each text in a task, and the counters of rows that are already settled."""
    def run(batches):
        def flushed():
            late = [(part, kind, n) for (part, kind), n in changes.items() if kind & LATER and n]
            first = [(text, doc, part, kind, n) for text, (doc, cells) in holders.items()
                     for (part, kind), n in cells.items()]
            shard = [int.from_bytes(x[0][:7], "little") % shards for x in first]
            spread = [hash(x[1]) % shards for x in late]
            return pa.RecordBatch.from_arrays([
                pa.array(shard + spread, pa.int64()),
                pa.array([x[0] for x in first] + [None] * len(late), pa.binary()),
                pa.array([x[1] for x in first] + [None] * len(late), pa.int64()),
                *(pa.array([x[-3 + i] for x in first + late], kind) for i, kind in enumerate(
                    (pa.string(), pa.int32(), pa.int64())))],
                ["shard", "text", "doc", "part", "class", "n"])

        holders, changes = Holders(), Counter()
        for batch in batches:
            for text, doc, part, kind in zip(*(batch.column(c).to_pylist() for c in (
                    "text", "doc", "part", "class"))):
                holders.add(changes, text, doc, (part, kind), 1)
            if len(holders) > HELD:
                yield flushed()
                holders, changes = Holders(), Counter()
        yield flushed()

    return rows.mapInArrow(run, CHANGE)


def _advance(key, batches, state):
    """Adds the rows of a shard to its holders; gives the changes of the counters."""
    holders = Holders(pickle.loads(state.get[0]) if state.exists else {})
    changes: Counter = Counter()
    for rows in batches:
        for text, doc, part, kind, n in zip(*(rows[c] for c in ("text", "doc", "part", "class", "n"))):
            if text is None:
                changes[part, kind] += n
            else:
                holders.add(changes, bytes(text), int(doc), (part, int(kind)), int(n))
    state.update((pickle.dumps(dict(holders)),))
    found = [(part, kind, n) for (part, kind), n in changes.items() if n]
    yield pd.DataFrame(found, columns=["part", "class", "n"])


def stream_of(spark: SparkSession, path: str, schema: StructType, files: list[str],
              batches: int) -> DataFrame:
    """The files of ``path`` (a folder, or one file) as a stream of so many micro-batches at most."""
    rows = spark.readStream.schema(schema).option(
        "maxFilesPerTrigger", max(1, math.ceil(len(files) / batches)))
    folder, name = path.rstrip("/").rsplit("/", 1)
    if len(files) == 1 and files[0].endswith(f"/{name}"):
        return rows.option("pathGlobFilter", name).parquet(folder)
    return rows.parquet(path)


def counters(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """part, class and n, summed from the changes that the micro-batches over the files of ``path``
    made."""
    table = spark.read.parquet(path)
    shards = max(1, table.count() // SHARD)
    docs = stream_of(spark, path, table.schema, table.inputFiles(), batches)
    known = stored(labels_by_doc(labels), "audit-labels")
    rows = judged(docs).join(known, ["doc", "salt"], "left").select(
        "text", "doc", "part", F.col("class").bitwiseOR(F.coalesce("labels", F.lit(0))).alias("class"))
    changes = reduced(rows, shards).groupBy("shard").applyInPandasWithState(
        _advance, "part string, class int, n long", "holders binary", "append",
        GroupStateTimeout.NoTimeout)
    folder = scratch_dir(spark, "audit-counters")

    def keep(batch: DataFrame, number: int) -> None:
        batch.groupBy("part", "class").agg(F.sum("n").alias("n")).coalesce(1).write.mode(
            "overwrite").parquet(f"{folder}/batch={number}")

    changes.writeStream.foreachBatch(keep).outputMode("append").option(
        "checkpointLocation", scratch_dir(spark, "audit-stream")).trigger(
        availableNow=True).start().awaitTermination()
    kind = "part string, class int, n long"
    if not path_exists(spark, folder):
        return spark.createDataFrame([], kind)
    return spark.read.schema(kind).parquet(folder).groupBy("part", "class").agg(F.sum("n").alias("n"))


def _orders(key, rows):
    """The steps of all orders for one part."""
    kinds, n = rows.column("class").to_numpy(), rows.column("n").to_numpy()
    masks = np.arange(2 * LATER)
    total, good, toxic = (np.bincount(kinds[chosen] % len(masks), n[chosen], len(masks)).astype(np.int64)
                          for chosen in (kinds >= 0, kinds & GOOD > 0, kinds & TOXIC > 0))
    steps, removed_by = [], Counter()
    for order in itertools.permutations(FILTERS):
        before = 0
        for step, name in enumerate(order, 1):
            bit = 1 << FILTERS.index(name)
            alive, fails = masks & before == 0, masks & bit > 0
            gone = alive & fails
            steps.append(("".join(order), step, name, int(total[alive & ~fails].sum()),
                          int(total[gone].sum()), int(total[~alive & fails].sum()), int(total[bit]),
                          int(good[gone].sum()), int(toxic[gone].sum())))
            removed_by[name] += steps[-1][4]
            before |= bit
    columns = [*zip(*steps)]
    return pa.table({
        "part": pa.repeat(pa.scalar(key[0].as_py(), pa.string()), len(steps)), "filter_order": columns[0],
        "step": pa.array(columns[1], pa.int32()),
        **dict(zip(("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"), columns[3:])),
        "shapley": [removed_by[name] for name in columns[2]]})


def audit(spark: SparkSession, path: str, labels: DataFrame, batches: int = BATCHES) -> DataFrame:
    """Per part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost and shapley, for the documents in the Parquet files of ``path``."""
    return counters(spark, path, labels, batches).groupBy("part").applyInArrow(_orders, (
        "part string, filter_order string, step int, kept long, removed long, redundant long, "
        "unique_fails long, good_lost long, toxic_lost long, shapley long"))


FILTER_AUDIT_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals FROM texts),
judged AS (
  SELECT doc_id, part,
    (len(w) < 100)::INT + 2 * (100 * list_unique(w) < 80 * len(w))::INT
    + 4 * (100 * capitals > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
    + 16 * (min(doc_id) OVER (PARTITION BY t) < doc_id)::INT AS mask
  FROM words),
known AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic
  FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM judged LEFT JOIN known USING (doc_id) GROUP BY part, mask),
f(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31),
steps AS (SELECT filter_order, bits, unnest(range(1, 6)) AS step FROM orders),
placed AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS earlier
  FROM steps),
found AS (
  SELECT part, filter_order, step::INT AS step, bit,
    coalesce(sum(n) FILTER (WHERE mask & earlier = 0 AND mask & bit = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE mask & earlier = 0 AND mask & bit > 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE mask & earlier > 0 AND mask & bit > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (WHERE mask & earlier = 0 AND mask & bit > 0), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (WHERE mask & earlier = 0 AND mask & bit > 0), 0)::BIGINT AS toxic_lost
  FROM cells, placed GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM found
"""
