"""SimHash near-dedup by Golay-code fuzzy hashing.

A 64-bit fingerprint has bit i set if over half of the text's shingle hashes have it set. Documents
whose fingerprints differ in at most four bits are linked, and linked documents form groups.

Candidates come from the perfect Golay code of 23 bits, which decodes every word to the codeword at
three bits or less. Around a word lie one codeword within three bits and, where that is exactly
three away, five more at four bits: six keys at most. Then

* words that differ in one bit: the decoded codeword of each is a key of the other,
* words that differ in two bits: they share a key.

The fingerprint is cut into segments of 22, 21 and 21 bits, filled up with zeros. Four differing
bits over three segments leave either one segment equal and another with at most two, or two
segments with one each. So the keys of a fingerprint are, for every ordered pair of segments, one
segment as it is with each key of the other; and the decoded codeword of one with each key of the
other, tagged alike for either order. Two fingerprints within four bits share a key in every case;
that the others do not matter is settled by comparing all 64 bits of those that share one.

Equal fingerprints are taken together first, so copies cost one row. The fingerprints of a key are
searched breadth first: each one found takes all within four bits out of the rest, so a dense group
is used up in few steps and gives a link less than it has members, never all pairs. A key's group
holds distinct numbers that share two Golay codewords; its size is bounded by them and not by the
copies in the corpus, and it needs eight bytes each. A group of more than ``BLOCK`` is cut into blocks,
and each block is compared with each other one in a cell of its own, which any task may take.

A null or empty text has no words and fingerprint zero. Rows of the same doc_id are documents of
their own and may have different groups; component_id is the smallest doc_id of the group, null if
all of them are null. Only doc_id and text are read; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.common import bounded_broadcast, pieces, same, stored, text_key
from barwright.llm.components import components

SHINGLE = 4
BITS = 4
SEED = 42
# Fingerprints of a key that one task searches at once.
BLOCK = 1 << 14
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Generator polynomial of the binary Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    tokens = (text or "").encode().lower().split()  # of bytes: A-Z only, ASCII white space only
    if not tokens:
        return 0
    line = b" ".join(tokens)
    if len(tokens) <= words:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = [0, *(ends[:-words] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], SEED)
                       for a, b in zip(starts, ends[words - 1:].tolist())], "<u8")
    return majority(hashes)


def majority(hashes: np.ndarray, step: int = 65_536) -> int:
    """The number whose bits are set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), step):
        part = hashes[at:at + step].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, words: int = SHINGLE) -> DataFrame:
    """doc_id, text_key and fp (the fingerprint as a signed long) of every row."""
    def run(batches):
        for batch in pieces(batches):
            found = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()],
                             np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(found.view(np.int64))],
                ["doc_id", "text_key", "fp"])

    rows = docs.select("doc_id", text_key().alias("text_key"),
                       docs["text"].cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_key long, fp long")


def remainder(word: np.ndarray) -> np.ndarray:
    """Syndromes: remainders modulo the generator polynomial."""
    word = np.array(word, np.int64)
    for bit in range(22, 10, -1):
        word ^= np.where(word >> bit & 1, GENERATOR << (bit - 11), 0)
    return word


@lru_cache(maxsize=1)
def error_patterns() -> np.ndarray:
    """Per syndrome, the errors to the codewords nearby: the nearest first, then those at four
    bits, filled up with -1."""
    patterns = [[] for _ in range(2048)]
    for weight in range(5):
        errors = np.array([sum(1 << i for i in c) for c in combinations(range(23), weight)])
        for error, syndrome in zip(errors.tolist(), remainder(errors).tolist()):
            patterns[syndrome].append(error)
    table = np.full((2048, 6), -1, np.int64)
    for syndrome, errors in enumerate(patterns):
        table[syndrome, :len(errors)] = errors
    return table


def codewords(segment: np.ndarray) -> np.ndarray:
    """For each 23-bit word the numbers of its six codewords nearby, -1 where there are fewer.
    The upper 12 bits of a codeword are its message and so its number."""
    errors = error_patterns()[remainder(segment)]
    return np.where(errors < 0, -1, (segment[:, None] ^ errors) >> 11)


def keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys, and the place in ``fps`` that each belongs to."""
    segments = [(fps >> np.uint64(at) & np.uint64((1 << n) - 1)).astype(np.int64)
                for at, n in SEGMENTS]
    near = [codewords(s) for s in segments]
    made, owner = [], []

    def add(tag: int, fixed: np.ndarray, codes: np.ndarray, fixed_first: bool) -> None:
        at, k = np.nonzero(codes >= 0)
        a, b = fixed[at], codes[at, k]
        body = a << 12 | b if fixed_first else b << 12 | a
        made.append(tag << 40 | body)
        owner.append(at)

    pairs = [(i, j) for i in range(3) for j in range(3) if i != j]
    for tag, (i, j) in enumerate(pairs):
        add(tag, segments[i], near[j], True)
    for tag, (i, j) in enumerate([(0, 1), (0, 2), (1, 2)], len(pairs)):
        add(tag, near[i][:, 0], near[j], True)
        add(tag, near[j][:, 0], near[i], False)
    return np.concatenate(made), np.concatenate(owner)


def forest(fps: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links that join what steps of at most ``bits`` bits join, one less than members."""
    links, rest = [], np.unique(fps)
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            here = queue.pop()
            close = np.bitwise_count(rest ^ here) <= bits
            if close.any():
                found = rest[close]
                links.extend((here, x) for x in found)
                queue.extend(found)
                rest = rest[~close]
    return links


def bridges(left: np.ndarray, right: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links between two blocks of a key that join what steps of at most ``bits`` bits from one block
    to the other join, one less than members."""
    links, root = [], {}

    def top(x: int) -> int:
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for here in np.unique(left).tolist():
        close = right[np.bitwise_count(right ^ np.uint64(here)) <= bits]
        for there in close.tolist():
            a, b = top(here), top(there)
            if a != b:
                root[a] = b
                links.append((here, there))
    return links


def linked(fps: DataFrame, bits: int = BITS, block: int = BLOCK) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that join every group.

    A key with more than ``block`` fingerprints is cut into blocks by a hash: each is searched, and each
    is compared with each other one, in cells that tasks share.
    """
    if bits > BITS:
        raise ValueError("the segments find pairs of at most four differing bits")

    def spread(batches):
        for batch in pieces(batches, 4096):
            values = batch.column("fp").to_numpy().view(np.uint64)
            key, owner = keys(values)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(values[owner].view(np.int64))], ["key", "fp"])

    def links(found):
        a, b = (np.array([x[i] for x in found], np.uint64).view(np.int64) for i in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def search(batches):
        def groups(key, values):
            at = np.flatnonzero(np.diff(key)) + 1
            return links([x for group in np.split(values, at) if len(group) > 1
                          for x in forest(group, bits)])

        held = [], []
        for batch in batches:
            key = batch.column("key").to_numpy()
            values = batch.column("fp").to_numpy().view(np.uint64)
            if not len(key):
                continue
            # The last key of a batch may go on in the next one.
            cut = np.searchsorted(key, key[-1])
            if cut or held[0] and held[0][-1][-1] != key[-1]:
                yield groups(np.concatenate([*held[0], key[:cut]]),
                             np.concatenate([*held[1], values[:cut]]))
                held = [], []
            held[0].append(key[cut:].copy())
            held[1].append(values[cut:].copy())
        if held[0]:
            yield groups(np.concatenate(held[0]), np.concatenate(held[1]))

    def meet(cell, rows):
        values = rows.column("fp").to_numpy().view(np.uint64)
        own = rows.column("own").to_numpy()
        low, high = cell[1].as_py(), cell[2].as_py()
        found = forest(values, bits) if low == high else bridges(
            values[own == low], values[own == high], bits)
        return pa.Table.from_batches([links(found)])

    keyed = fps.select("fp").mapInArrow(spread, "key long, fp long")
    sizes = keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block)
    large = bounded_broadcast(stored(sizes, "simhash-large"))
    small = keyed.join(large, "key", "left_anti").repartition("key").sortWithinPartitions(
        "key").mapInArrow(search, "a long, b long")
    own = F.pmod(F.xxhash64(F.lit("block"), "fp"), F.col("parts")).cast("int")
    cells = keyed.join(large, "key").withColumn("parts", F.ceil(F.col("n") / block).cast("int")) \
        .withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))) \
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                "own", "fp")
    return small.unionByName(cells.groupBy("key", "low", "high").applyInArrow(
        meet, "a long, b long")).distinct()


def near_duplicates(docs: DataFrame, words: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """doc_id, text_key, fp, root (smallest fingerprint of the group) and component_id of every
    row."""
    rows = stored(fingerprints(docs, words), "simhash")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    roots = stored(components(linked(classes, bits)), "simhash-roots")
    rooted = classes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    groups = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(rooted.select("fp", "root").join(groups, "root"), "fp").select(
        "doc_id", "text_key", "fp", "root", "component_id")


def simhash_groups(docs: DataFrame, words: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    return near_duplicates(docs, words, bits).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, words: int = SHINGLE, bits: int = BITS) -> DataFrame:
    """Of each group of near-duplicates one row of ``docs``, whole: the one with the smallest
    doc_id, null being the largest; of several such rows an arbitrary but fixed text."""
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    keep = near_duplicates(docs, words, bits).groupBy("root").agg(F.min(row).alias("keep")).select(
        "keep.doc_id", "keep.text_key")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col("doc_id").alias("id"), text_key().alias("key"))
    kept = whole.join(keep, same(F.col("id"), F.col("doc_id"), F.col("key"), F.col("text_key")),
                      "left_semi")
    repeats = Window.partitionBy("id", "key").orderBy("key")
    return kept.withColumn("n", F.row_number().over(repeats)).where("n = 1").select("row.*")
