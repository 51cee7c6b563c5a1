"""Queries of this folder with the SQL each is checked against (None: no SQL twin)."""

from __future__ import annotations

from tamizal.llm import (
    embedding_dedup,
    mixing,
    page_text,
    prefix_trie,
    quality_rules,
    secret_scan,
    sentence_pieces,
    simhash_dedup,
    substring_dedup,
    token_files,
    toxicity,
    url_filter,
    vector_codes,
)

QUERIES = {
    "op1_substring_dedup": (substring_dedup.op1_substring_dedup, substring_dedup.OP1_SQL),
    "op2_quality_rules": (quality_rules.op2_quality_rules, quality_rules.OP2_SQL),
    "op3_page_text": (page_text.op3_page_text, None),
    "op4_token_files": (token_files.op4_token_files, None),
    "op5_embedding_dedup": (embedding_dedup.op5_embedding_dedup, embedding_dedup.OP5_SQL),
    "op6_sentence_pieces": (sentence_pieces.op6_sentence_pieces, None),
    "op7_simhash_dedup": (simhash_dedup.op7_simhash_dedup, None),
    "op8_secret_scan": (secret_scan.op8_secret_scan, secret_scan.OP8_SQL),
    "op9_toxicity": (toxicity.op9_toxicity, None),
    "op10_mixing": (mixing.op10_mixing, mixing.OP10_SQL),
    "op11_vector_codes": (vector_codes.op11_vector_codes, vector_codes.OP11_SQL),
    "op12_url_filter": (url_filter.op12_url_filter, None),
    "op13_prefix_trie": (prefix_trie.op13_prefix_trie, prefix_trie.OP13_SQL),
}
