"""Line dedup by range-partitioned hashes, with DataFrame functions only.

Each line of a text has a key: its text without ASCII white space at both ends and with A-Z lower-
cased. A key of at least ``least`` code points that stands in two documents or more loses all its
lines except in the document with the smallest doc_id. Only 128-bit hashes of keys travel, ranged
by (hash, doc_id, position), so that a frequent key is spread over several ranges; each range is
streamed in that order, the first occurrence of a key going down its run. Keys that reach over the
end of a range, at most two a range, take their first occurrence from a small table. What comes
back is a bitmap per document, not text.

A null or empty text is one empty line and stays as it is. A null doc_id counts as the largest; rows
of the same doc_id are one document, so repeated rows lose the same lines. Only doc_id and text are
read, so other columns may have any name; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barwright.llm.common import SPACES, UPPER, same, stored, text_key

LEAST = 10
KEY = ["h1", "h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """h1, h2, doc_id, text_key and pos (from 0) of every line whose key is long enough."""
    lines = docs.select(F.col("doc_id").alias("doc_id"), text_key().alias("text_key"),
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(SPACES)), UPPER, UPPER.lower())
    # The trimmed length is that of the key. Short lines go before their letters are changed.
    return lines.where(F.char_length(F.btrim("line", F.lit(SPACES))) >= least).select(
        F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"),
        "doc_id", "text_key", "pos")


def ranged(hashes: DataFrame) -> DataFrame:
    """The hashes in ranges of (hash, doc_id, position), each row with the number of its range."""
    order = [*KEY, F.col("doc_id").asc_nulls_last(), "text_key", "pos"]
    # Written first: finding the ranges reads the rows twice, and the texts should be read once.
    parts = stored(hashes, "line-hashes").repartitionByRange(*order)
    return stored(parts.withColumn("part", F.spark_partition_id()), "line-ranges")


def boundary_firsts(ranges: DataFrame) -> DataFrame:
    """First document of each key that begins or ends a range: at most two rows a range."""
    ends = ranges.groupBy("part").agg(
        F.min(F.struct(*KEY)).alias("low"), F.max(F.struct(*KEY)).alias("high"))
    keys = ends.select(F.explode(F.array("low", "high")).alias("key")).select("key.*").distinct()
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"))
    return ranges.join(F.broadcast(keys), KEY).groupBy(*KEY).agg(
        F.struct(F.min_by("doc_id", order).alias("doc_id")).alias("edge"))


def dropped_lines(ranges: DataFrame) -> DataFrame:
    """doc_id, text_key and pos of every line to drop."""
    run = Window.partitionBy("part").orderBy(
        *KEY, F.col("doc_id").asc_nulls_last(), "text_key", "pos")
    begins = ~same(F.lag("h1").over(run), F.col("h1"), F.lag("h2").over(run), F.col("h2"))
    rows = ranges.withColumn("begins", begins).withColumn("run_first", F.last(
        F.when(F.col("begins"), F.struct("doc_id")), ignorenulls=True).over(run))
    first = F.coalesce("edge", "run_first")["doc_id"]
    return rows.join(F.broadcast(boundary_firsts(ranges)), KEY, "left").where(
        ~first.eqNullSafe(F.col("doc_id"))).select("doc_id", "text_key", "pos")


def keep_bitmaps(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, text_key and keep: 64 lines to a word, a bit being 1 if the line stays.

    Documents that keep all lines have no row, and words after the last dropped line are left out.
    """
    word, bit = F.shiftright("pos", 6), F.col("pos").bitwiseAND(63)
    words = dropped_lines(ranged(line_hashes(docs, least))).select(
        "doc_id", "text_key", word.alias("word"), F.expr("shiftleft(1L, pos & 63)").alias("bit")
    ).groupBy("doc_id", "text_key", "word").agg(F.bit_or("bit").alias("bits"))
    found = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
    return words.groupBy("doc_id", "text_key").agg(
        found.alias("found"), F.max("word").alias("last")).select(
        "doc_id", "text_key", F.transform(
            F.sequence(F.lit(0), "last"),
            lambda w: F.bitwise_not(F.coalesce(F.element_at("found", w), F.lit(0).cast("long")))
        ).alias("keep"))


def with_kept_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """All rows and columns of ``docs`` in a struct ``row``, with n_lines, n_dropped and kept, the
    text of the lines that stay (null if the text is null)."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    maps = keep_bitmaps(docs, least).select(F.struct("*").alias("map"))
    joined = rows.join(maps, same(
        F.col("row.doc_id"), F.col("map.doc_id"),
        text_key(F.col("row.text")), F.col("map.text_key")), "left")
    lines = lines_of(F.col("row.text"))
    keep = F.col("map.keep")

    def stays(line: Column, pos: Column) -> Column:
        bits = F.get(keep, F.shiftright(pos, 6))
        return bits.isNull() | (F.expr("0L") != bits.bitwiseAND(
            F.call_function("shiftleft", F.expr("1L"), pos.bitwiseAND(63))))

    kept = F.when(keep.isNull(), F.col("row.text")).otherwise(
        F.array_join(F.filter(lines, stays), "\n"))
    dropped = F.when(keep.isNull(), F.expr("0L")).otherwise(
        F.aggregate(keep, F.expr("0L"), lambda n, w: n + F.bit_count(F.bitwise_not(w))))
    return joined.select("row", F.size(lines).cast("long").alias("n_lines"),
                         dropped.alias("n_dropped"), kept.alias("kept"))


def dedup_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every text."""
    return with_kept_lines(docs.select("doc_id", "text"), least).select(
        "row.doc_id", "n_lines", "n_dropped",
        F.sha2(F.coalesce("kept", F.lit("")), 256).alias("kept_sha256"))


LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
firsts AS (
  SELECT k, min(doc_id) AS f FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT doc_id, pos, line, f IS NULL OR f = doc_id AS stays FROM keyed LEFT JOIN firsts USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT stays) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE stays), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id
"""
