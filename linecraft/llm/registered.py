"""Queries of the operators in this package, over whole tables, and their SQL."""

from __future__ import annotations

from . import (
    byte_cnn,
    conversations,
    fm_index,
    html_layout,
    mtree,
    packing,
    phrases,
    resharding,
    secrets,
    superminhash,
    token_counts,
    url_rules,
    weak_toxicity,
)
from ._common import DOCUMENTS, table
from .oracles import ORACLE_SQL


def op1_superminhash_near_duplicates(spark, d):
    return superminhash.digest(table(spark, d, "documents", DOCUMENTS))


def op2_mtree_top_scores(spark, d):
    return mtree.digest(spark.read.parquet(f"{d.rstrip('/')}/embeddings.parquet"))


def op3_secret_scan(spark, d):
    return secrets.digest(table(spark, d, "documents", DOCUMENTS))


def op4_cutting_stock_packing(spark, d):
    return packing.digest(table(spark, d, "documents", DOCUMENTS))


def op5_edit_token_counts(spark, d):
    return token_counts.digest(table(spark, d, "documents", DOCUMENTS))


def op6_fm_index_decontamination(spark, d):
    benchmark = spark.read.parquet(f"{d.rstrip('/')}/benchmark.parquet")
    return fm_index.digest(table(spark, d, "documents", DOCUMENTS), benchmark)


def op7_byte_cnn_quality(spark, d):
    labels = spark.read.parquet(f"{d.rstrip('/')}/labels.parquet")
    return byte_cnn.digest(table(spark, d, "documents", DOCUMENTS), labels)


def op8_url_rules(spark, d):
    pages = table(spark, d, "pages", "page_id bigint, url string")
    return url_rules.judge(pages, url_rules.rules_frame(spark))


def op9_weak_supervision_toxicity(spark, d):
    labels = spark.read.parquet(f"{d.rstrip('/')}/labels.parquet")
    return weak_toxicity.digest(table(spark, d, "documents", DOCUMENTS), labels)


def op10_html_layout(spark, d):
    return html_layout.extract(table(spark, d, "pages", "page_id bigint, html string"))


def op11_vertical_suffix_phrases(spark, d):
    return phrases.digest(table(spark, d, "documents", "lang string, text string"))


def op12_flow_resharding(spark, d):
    return resharding.digest(table(spark, d, "documents", "doc_id bigint, text string, source string"))


def op13_cyk_conversation_repair(spark, d):
    return conversations.digest(table(spark, d, "conversations", "conv_id bigint, turn bigint, role string, text string"))


QUERIES = {
    "op1_superminhash_near_duplicates": op1_superminhash_near_duplicates,
    "op2_mtree_top_scores": op2_mtree_top_scores,
    "op3_secret_scan": op3_secret_scan,
    "op4_cutting_stock_packing": op4_cutting_stock_packing,
    "op5_edit_token_counts": op5_edit_token_counts,
    "op6_fm_index_decontamination": op6_fm_index_decontamination,
    "op7_byte_cnn_quality": op7_byte_cnn_quality,
    "op8_url_rules": op8_url_rules,
    "op9_weak_supervision_toxicity": op9_weak_supervision_toxicity,
    "op10_html_layout": op10_html_layout,
    "op11_vertical_suffix_phrases": op11_vertical_suffix_phrases,
    "op12_flow_resharding": op12_flow_resharding,
    "op13_cyk_conversation_repair": op13_cyk_conversation_repair,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
