"""Queries of this subpackage and their DuckDB texts."""

from __future__ import annotations

from . import bpe_tree, chat, media, packing, quality_classifier, quality_rules, simhash, token_counts, toxicity, url_filter

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_bpe_tree": bpe_tree.op2_bpe_tree,
    "op3_chat": chat.op3_chat,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_packing": packing.op5_packing,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_simhash": simhash.op7_simhash,
    "op8_url_filter": url_filter.op8_url_filter,
    "op9_media": media.op9_media,
    "op10_quality_classifier": quality_classifier.op10_quality_classifier,
}

ORACLES = {
    "op4_quality_rules": quality_rules.ORACLE_SQL,
    "op8_url_filter": url_filter.ORACLE_SQL,
}
