"""Registered queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from wavefold.llm import (
    byte_bpe,
    embedding_dedup,
    exact_search,
    html_text,
    line_dedup,
    mixing,
    ngram_join,
    product_codes,
    quality,
    sharding,
    substring_dedup,
    suffix_dedup,
    whitening,
)

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_source_mixing": mixing.op3_source_mixing,
    "op4_sharding": sharding.op4_sharding,
    "op5_byte_bpe": byte_bpe.op5_byte_bpe,
    "op6_quality_rules": quality.op6_quality_rules,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_embedding_dedup": embedding_dedup.op8_embedding_dedup,
    "op9_html_text": html_text.op9_html_text,
    "op10_substring_dedup": substring_dedup.op10_substring_dedup,
    "op11_exact_search": exact_search.op11_exact_search,
    "op12_product_codes": product_codes.op12_product_codes,
    "op13_whitening": whitening.op13_whitening,
}

ORACLE = {
    "op1_line_dedup": line_dedup.ORACLE,
    "op6_quality_rules": quality.ORACLE,
    "op10_substring_dedup": substring_dedup.ORACLE,
    "op11_exact_search": exact_search.ORACLE,
    "op12_product_codes": product_codes.ORACLE,
}
