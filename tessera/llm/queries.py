"""The registered queries of this subpackage, one for each operator, and their SQL where SQL can say it."""

from __future__ import annotations

from tessera.llm import lines, near_dedup, neighbours, packing, passages, pieces, private, substrings, topk, toxicity

QUERIES = {
    "op1_substring_dedup": substrings.query,
    "op2_pii_pseudonyms": private.query,
    "op3_sentencepiece": pieces.query,
    "op4_nearest_neighbours": neighbours.query,
    "op5_line_dedup": lines.query,
    "op6_toxicity": toxicity.query,
    "op7_topk_search": topk.query,
    "op8_minhash_near_dedup": near_dedup.query,
    "op9_packing": packing.query,
    "op10_paragraph_dedup": passages.query,
}

ORACLES = {"op7_topk_search": topk.ORACLE}
