"""Registered queries of this subpackage and their DuckDB twins."""

from __future__ import annotations

from foldwise.llm import bpe_trie, cover_tree, hmm_lm, importance, itq_dedup, mixing, ngram_join, pii_offsets, quality_rules, secret_grammar, segment_resampling, suffix_decontamination, warc

QUERIES = {
    "op1_ngram_jaccard_join": ngram_join.op1_ngram_jaccard_join,
    "op2_quality_rules": quality_rules.op2_quality_rules,
    "op3_warc_derivatives": warc.op3_warc_derivatives,
    "op4_importance_resampling": importance.op4_importance_resampling,
    "op5_itq_near_duplicates": itq_dedup.op5_itq_near_duplicates,
    "op6_bpe_trie": bpe_trie.op6_bpe_trie,
    "op7_pivotal_mixing": mixing.op7_pivotal_mixing,
    "op8_pii_offsets": pii_offsets.op8_pii_offsets,
    "op9_secret_grammar": secret_grammar.op9_secret_grammar,
    "op10_hmm_language_model": hmm_lm.op10_hmm_language_model,
    "op11_cover_tree_negatives": cover_tree.op11_cover_tree_negatives,
    "op12_suffix_decontamination": suffix_decontamination.op12_suffix_decontamination,
    "op13_segment_resampling": segment_resampling.op13_segment_resampling,
}

#: SQL where it can express the operator; the others are tested against brute force
ORACLE = {
    "op1_ngram_jaccard_join": ngram_join.ORACLE,
    "op2_quality_rules": quality_rules.ORACLE,
    "op3_warc_derivatives": warc.ORACLE,
    "op11_cover_tree_negatives": cover_tree.ORACLE,
    "op12_suffix_decontamination": suffix_decontamination.ORACLE,
    "op13_segment_resampling": segment_resampling.ORACLE,
}
