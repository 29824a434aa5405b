"""The corpus queries and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from tractworks.llm import brown_lm, decontaminate, html_extract, language_id, merkle, quality_classifier, quality_rules, recompression, sentencepiece_wfst, simhash, suffix_dedup, token_alignment, tree_bpe

QUERIES = {
    "op1_quality_classifier": quality_classifier.op1_quality_classifier,
    "op2_language_id": language_id.op2_language_id,
    "op3_brown_lm": brown_lm.op3_brown_lm,
    "op4_simhash": simhash.op4_simhash,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_substring_dedup": recompression.op6_substring_dedup,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op8_sentencepiece": sentencepiece_wfst.op8_sentencepiece,
    "op9_html_extract": html_extract.op9_html_extract,
    "op10_suffix_dedup": suffix_dedup.op10_suffix_dedup,
    "op11_tree_bpe": tree_bpe.op11_tree_bpe,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

SQL = {
    "op5_quality_rules": quality_rules.SQL,
    "op6_substring_dedup": recompression.SQL,
    "op7_decontaminate": decontaminate.SQL,
    "op10_suffix_dedup": suffix_dedup.SQL,
    "op12_merkle_manifest": merkle.SQL,
}
