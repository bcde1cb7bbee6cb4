"""A corpus from raw documents to piece ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept.
"""

from __future__ import annotations

import public_tokenizers

from barwright.llm import golay_simhash, line_dedup, quality, sentence_pieces, source_mix
from barwright.llm.common import stored, stored_inside, table
from barwright.session import remove
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand in an earlier one; n_chars counts what stays."""
    kept = line_dedup.with_kept_lines(docs)
    changed = {"text": F.col("kept"), "n_chars": F.char_length("kept").cast("long")}
    return kept.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return golay_simhash.one_of_each(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as the mix of sources takes them, repeated or cut."""
    return source_mix.mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document, and a digest of the text that they decode to."""
    return sentence_pieces.round_trips(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality classifier", good), ("line dedup", fresh_lines),
          ("simhash near-dedup", one_of_near), ("source mix", mixed),
          ("sentence pieces", encoded)]

# SQL has no classifier, piece encoder or seeded draws; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        with stored_inside() as made:
            docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        # What the stage wrote for itself and what it read are done with.
        for path in [*last, *made[:-1]]:
            remove(spark, path)
        last = made[-1:]
    return docs
