"""The operators over their whole tables: one query each, and the pipeline."""

from __future__ import annotations

import public_tokenizers

from barwright.llm import (edit_embedding, filter_audit, golay_simhash, language_id, license_scan,
                           line_dedup, quality, sentence_pieces, source_divergence, source_mix,
                           substring_dedup, token_counts, top_products)
from barwright.llm.common import table


def op1_sentence_pieces(spark, sf):
    return sentence_pieces.round_trips(table(spark, sf, "documents"),
                                       public_tokenizers.path("piece_bpe_32k.model"))


def op2_token_counts(spark, sf):
    return token_counts.token_counts(table(spark, sf, "documents"),
                                     public_tokenizers.path("byte_bpe_50k.json"))


def op3_edit_embedding(spark, sf):
    return edit_embedding.edit_classes(table(spark, sf, "documents"))


def op4_top_products(spark, sf):
    return top_products.top_products(table(spark, sf, "embeddings"))


def op5_golay_simhash(spark, sf):
    return golay_simhash.simhash_groups(table(spark, sf, "documents"))


def op6_line_dedup(spark, sf):
    return line_dedup.dedup_lines(table(spark, sf, "documents"))


def op7_quality(spark, sf):
    return quality.scored(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op8_license_scan(spark, sf):
    return license_scan.scan_licenses(table(spark, sf, "documents"))


def op9_language_id(spark, sf):
    return language_id.identify(table(spark, sf, "documents"))


def op10_source_mix(spark, sf):
    return source_mix.mix_sources(table(spark, sf, "documents"))


def op11_source_divergence(spark, sf):
    return source_divergence.divergences(table(spark, sf, "documents"))


def op12_substring_dedup(spark, sf):
    return substring_dedup.remove_repeats(table(spark, sf, "documents"))


def op13_filter_audit(spark, sf):
    return filter_audit.audit(spark, f"{sf}/documents.parquet", table(spark, sf, "labels"))


QUERIES = {f.__name__: f for f in (
    op1_sentence_pieces, op2_token_counts, op3_edit_embedding, op4_top_products,
    op5_golay_simhash, op6_line_dedup, op7_quality, op8_license_scan, op9_language_id,
    op10_source_mix, op11_source_divergence, op12_substring_dedup, op13_filter_audit)}

ORACLE = {
    "op4_top_products": top_products.TOP_PRODUCTS_SQL,
    "op6_line_dedup": line_dedup.LINE_DEDUP_SQL,
    "op8_license_scan": license_scan.license_scan_sql(),
    "op11_source_divergence": source_divergence.DIVERGENCE_SQL,
    "op12_substring_dedup": substring_dedup.SUBSTRING_SQL,
    "op13_filter_audit": filter_audit.FILTER_AUDIT_SQL,
}
