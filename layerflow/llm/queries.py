"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from layerflow.llm import decontaminate, hard_negatives, jaccard_join, language_id, license_scan, line_dedup, merge_dropout, multi_index, page_text, spelling_variants, suffix_dedup, token_store, toxicity

QUERIES = {
    "op1_line_dedup": line_dedup.op1_line_dedup,
    "op2_multi_index": multi_index.op2_multi_index,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_page_text": page_text.op4_page_text,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_language_id": language_id.op6_language_id,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_token_store": token_store.op8_token_store,
    "op9_merge_dropout": merge_dropout.op9_merge_dropout,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_spelling_variants": spelling_variants.op13_spelling_variants,
}

ORACLE = {
    "op5_jaccard_join": jaccard_join.ORACLE,
    "op7_decontaminate": decontaminate.ORACLE,
    "op11_hard_negatives": hard_negatives.ORACLE,
    "op13_spelling_variants": spelling_variants.ORACLE,
}
