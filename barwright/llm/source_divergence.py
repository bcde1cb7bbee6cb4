"""Divergence of the sources of each language, by Gustavson's row accumulation.

Terms are runs of letters and of everything beyond ASCII, with A-Z lower-cased. A language keeps the
terms of at least ``least`` of its documents. A group is a (lang, source) that occurs; it gives each
kept term p = 1 + floor(10^9 * (count + 5) / (N + 5 V)), N being the occurrences of kept terms in the
group and V the number of kept terms. A language as a whole has such a p as well. All of it is exact.

What the groups have in common is the product of a sparse matrix (groups by terms) with itself, with
|p - q| in place of a product. It is worked out as Gustavson does, row by row: the index by term is
cut into blocks of terms; in a block every group scatters its terms through the index into one dense
accumulator with a cell per peer, so no pair of postings is ever written. A term that a group lacks
is not 0 but the group's baseline: the accumulator starts from what the baselines of both groups
would give and is corrected at the terms that one or both hold. Blocks give their sums per pair of
groups, which are added up.

A null text, lang or source counts as ''. Every row is a document of its own, so repeated rows count
again. Groups without a term take part with their baseline; a language without kept terms gives its
pairs a value of 0. Only lang, source and text are read, so other columns may have any name. An
empty table gives an empty result. One source pairs with each other one of its language, which is
what is asked for, so the result grows with the square of the sources of a language, and an
accumulator holds one number for each of them.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.common import bounded_broadcast, pieces, stored

LEAST, TOP = 30, 50
ONE, PRIOR = 1_000_000_000, 5
# Entries of the index in a block of terms: at least, and at most in memory of one task.
BLOCK, LARGEST = 1 << 12, 1 << 21
# Terms that a task counts before it hands them on.
HELD = 400_000

# Letters keep their place, with A-Z lower-cased; every other byte of ASCII becomes a space.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
                   for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def _named(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit("")).alias(column)


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and docs (rows that hold it), counted in each task before
    the shuffle and then over all."""
    def run(batches):
        occurs: dict[tuple, Counter] = defaultdict(Counter)
        holds: dict[tuple, Counter] = defaultdict(Counter)

        def counted():
            for group, terms in occurs.items():
                names, held = list(terms), holds[group]
                yield pa.RecordBatch.from_arrays([
                    pa.array([group[0]] * len(names), pa.string()),
                    pa.array([group[1]] * len(names), pa.string()), pa.array(names, pa.binary()),
                    pa.array(terms.values(), pa.int64()),
                    pa.array([held[t] for t in names], pa.int64()),
                ], ["lang", "source", "term", "n", "docs"])
            occurs.clear()
            holds.clear()

        for batch in pieces(batches):
            for lang, source, text in zip(*(batch.column(c).to_pylist()
                                            for c in ("lang", "source", "text"))):
                terms = terms_of(text)
                occurs[lang, source].update(terms)
                holds[lang, source].update(set(terms))
            if sum(map(len, occurs.values())) > HELD:
                yield from counted()
        yield from counted()

    rows = docs.select(_named("lang"), _named("source"), F.coalesce(
        F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"))
    counts = rows.mapInArrow(run, "lang string, source string, term binary, n long, docs long")
    return counts.groupBy("lang", "source", "term").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source, term, n and total (in the language) of the kept terms; ``first`` marks one row of
    each term."""
    term = Window.partitionBy("lang", "term")  # as many rows as the language has sources
    return term_counts(docs).select(
        "*", F.sum("docs").over(term).alias("held"), F.sum("n").over(term).alias("total"),
        (F.min("source").over(term) == F.col("source")).alias("first")).where(
        F.col("held") >= least).select("lang", "source", "term", "n", "total", "first")


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 * (count + 5) / (total + 5 * terms)); 1 if there is no term at all."""
    whole = F.greatest(total + PRIOR * terms, F.expr("1L")).cast("decimal(20,0)")
    part = (count + F.lit(PRIOR)).cast("decimal(20,0)") * F.lit(ONE).cast("decimal(10,0)")
    return F.expr("1L") + F.call_function("div", part, whole)


def languages(counts: DataFrame) -> DataFrame:
    """lang, terms (kept ones), entries of the index and total occurrences of each language that keeps
    any."""
    return counts.groupBy("lang").agg(
        F.count_if("first").alias("terms"), F.count("*").alias("entries"),
        F.sum("n").alias("lang_n"))


def groups_of(docs: DataFrame, counts: DataFrame) -> DataFrame:
    """lang, source, g (number of the group in its language), groups of the language, terms, lang_n,
    blocks, n and zero (the p of a term that the group lacks)."""
    named = docs.select(_named("lang"), _named("source")).distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    of_lang = Window.partitionBy("lang")  # one row for each source of the language
    rows = named.join(sums, ["lang", "source"], "left").join(languages(counts), "lang", "left").select(
        "lang", "source", (F.row_number().over(of_lang.orderBy("source")) - 1).alias("g"),
        F.count("*").over(of_lang).alias("groups"),
        *[F.coalesce(c, F.expr("0L")).alias(c) for c in ("n", "terms", "entries", "lang_n")])
    # A block's sums are one for each pair of groups: not more of them than the block has entries.
    size = F.least(F.greatest(F.lit(BLOCK), F.col("groups") * F.col("groups")), F.lit(LARGEST))
    return rows.withColumn("blocks", F.ceil(F.greatest("entries", F.lit(1)) / size).cast("int")) \
        .withColumn("zero", share(F.lit(0), F.col("n"), F.col("terms"))).drop("entries")


def postings(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, g, block, term, p (the group's) and q (the language's) of each count."""
    return counts.join(bounded_broadcast(groups.withColumnRenamed("n", "group_n")),
                       ["lang", "source"]).select(
        "lang", "source", "g", "term",
        F.pmod(F.xxhash64("term"), "blocks").cast("int").alias("block"),
        share(F.col("n"), F.col("group_n"), F.col("terms")).alias("p"),
        share(F.col("total"), F.col("lang_n"), F.col("terms")).alias("q"))


class Block:
    """The index of a block of terms: for each term the groups that hold it, with their p."""

    def __init__(self, term: np.ndarray, group: np.ndarray, p: np.ndarray, zero: np.ndarray):
        order = np.argsort(term, kind="stable")
        self.group, self.p, self.zero = group[order], p[order], zero
        starts = np.flatnonzero(np.r_[True, term[order][1:] != term[order][:-1]][:len(term)])
        lengths = np.diff(np.r_[starts, len(term)])
        self.terms = len(starts)
        # Of each entry: where the entries of its term begin, and how many there are.
        self.start, self.length = np.repeat(starts, lengths), np.repeat(lengths, lengths)
        self.row = np.argsort(self.group, kind="stable")
        self.rows = np.searchsorted(self.group[self.row], np.arange(len(zero) + 1))
        self.held = np.diff(self.rows)
        # Entries by (group, p) with running sums of p, to add up |p - x| over a whole group.
        self.key = np.sort(self.group.astype(np.int64) << 32 | self.p)
        self.sums = np.r_[0, np.cumsum(self.key & (1 << 32) - 1)]

    def far_from(self, x: int) -> np.ndarray:
        """For each group the sum of |p - x| over the terms that it holds."""
        peers = np.arange(len(self.zero), dtype=np.int64)
        cut = np.searchsorted(self.key, peers << 32 | x)
        low, high = self.rows[:-1], self.rows[1:]
        below = x * (cut - low) - (self.sums[cut] - self.sums[low])
        return below + (self.sums[high] - self.sums[cut]) - x * (high - cut)

    def accumulated(self, g: int) -> np.ndarray:
        """The row of group ``g``: for each peer the sum of |p - q| over all terms of the block."""
        mine, zero, x = self.row[self.rows[g]:self.rows[g + 1]], self.zero, int(self.zero[g])
        base = np.abs(zero - x)
        # Every term at both baselines, then each side's own terms against the other's baseline.
        row = base * (self.terms - self.held[g] - self.held) + self.far_from(x)
        own = np.sort(self.p[mine])
        sums, cut = np.r_[0, np.cumsum(own)], np.searchsorted(own, zero)
        row += zero * (2 * cut - len(own)) + sums[-1] - 2 * sums[cut]
        # Terms held by both: scatter through the index.
        lengths = self.length[mine]
        at = np.repeat(self.start[mine] - np.r_[0, np.cumsum(lengths)[:-1]], lengths) \
            + np.arange(lengths.sum())
        peer, theirs, ours = self.group[at], self.p[at], np.repeat(self.p[mine], lengths)
        np.add.at(row, peer, np.abs(ours - theirs) - np.abs(ours - zero[peer])
                  - np.abs(theirs - x) + base[peer])
        return row


def _block_sums(key, rows):
    """g, h and value of every pair of groups over one block."""
    g, p = (rows.column(c).to_numpy() for c in ("g", "p"))
    own = rows.column("term").is_null().to_numpy()
    zero = np.zeros(own.sum(), np.int64)
    zero[g[own]] = p[own]
    names = rows.column("term").filter(pa.array(~own)).combine_chunks().dictionary_encode()
    block = Block(names.indices.to_numpy(), g[~own], p[~own], zero)
    n = len(zero)
    sums = np.concatenate([block.accumulated(i) for i in range(n)]) if n else np.zeros(0, np.int64)
    return pa.table({"lang": pa.repeat(pa.scalar(key[0].as_py(), pa.string()), n * n),
                     "g": np.repeat(np.arange(n, dtype=np.int32), n),
                     "h": np.tile(np.arange(n, dtype=np.int32), n), "value": sums})


def pair_sums(posts: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, g, h and value of every two groups of a language."""
    baselines = groups.select("lang", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"),
                              F.lit(None).cast("binary").alias("term"), "g", F.col("zero").alias("p"))
    rows = posts.select("lang", "block", "term", "g", "p").unionByName(baselines)
    parts = rows.groupBy("lang", "block").applyInArrow(
        _block_sums, "lang string, g int, h int, value long")
    return parts.where("g <> h").groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


def _ranked(rows: DataFrame, part: str, most: int | None = None) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    rows = rows.withColumn("rank", rank)
    return (rows.where(F.col("rank") <= most) if most else rows).select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank")


def divergences(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value and rank: the other sources of each source's language by their
    divergence (``pair``), and the ``top`` terms that it has more often than its language (``term``)."""
    counts = stored(kept_counts(docs, least), "divergence-counts")
    groups = stored(groups_of(docs, counts), "divergence-groups")
    posts = stored(postings(counts, groups), "divergence-postings")
    named = bounded_broadcast(groups.select("lang", "source", "g"))
    pairs = pair_sums(posts, groups).join(named, ["lang", "g"]).join(
        bounded_broadcast(groups.select("lang", F.col("g").alias("h"), F.col("source").alias("item"))),
        ["lang", "h"])
    terms = posts.where("p > q").select(
        "lang", "source", F.col("term").cast("string").alias("item"),
        (F.col("p") - F.col("q")).alias("value"))
    return _ranked(pairs.select("lang", "source", "item", "value"), "pair").unionByName(
        _ranked(terms, "term", top))


DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
words AS (
  SELECT row_id, lang, source,
         unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term
  HAVING count(DISTINCT row_id) >= 30),
languages AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS lang_n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (
  SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term)
  GROUP BY lang, source, term),
sizes AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS group_n
  FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source),
shares AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 5)) // (group_n + 5 * v) AS p,
         1 + (1000000000::HUGEINT * (total + 5)) // (lang_n + 5 * v) AS q
  FROM sizes JOIN languages USING (lang) JOIN kept USING (lang)
  LEFT JOIN counts USING (lang, source, term)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 50
"""
