"""Registered queries of the training-data operators."""

from __future__ import annotations

from wattlake.llm import chat, exact_dedup, language_id, mixing, packing, quality_classifier, quality_rules, simhash, spelling, substring_dedup, suffix_dedup, trie, warc

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_quality_classifier": quality_classifier.op2_quality_classifier,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_warc": warc.op4_warc,
    "op5_substring_dedup": substring_dedup.op5_substring_dedup,
    "op6_simhash": simhash.op6_simhash,
    "op7_mixing": mixing.op7_mixing,
    "op8_best_fit_packing": packing.op8_best_fit_packing,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_chat_formatting": chat.op10_chat_formatting,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_language_id": language_id.op12_language_id,
    "op13_conversation_trie": trie.op13_conversation_trie,
}

ORACLE_SQL = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op4_warc": warc.ORACLE,
    "op5_substring_dedup": substring_dedup.ORACLE,
    "op10_chat_formatting": chat.ORACLE,
    "op13_conversation_trie": trie.ORACLE,
}
