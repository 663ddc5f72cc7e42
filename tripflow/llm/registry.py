"""The operators as queries over the given tables, and their SQL where there is one."""

from __future__ import annotations

from tripflow.llm import (
    conversation_trie,
    decontaminate,
    lang_id,
    merkle,
    mix_sources,
    near_copies,
    page_text,
    personal_data,
    quality_model,
    quality_rules,
    secret_scan,
    sketch,
    toxicity,
)

QUERIES = {
    "op1_secret_scan": secret_scan.query,
    "op2_quality_model": quality_model.query,
    "op3_toxicity": toxicity.query,
    "op4_decontamination": decontaminate.query,
    "op5_mix_sources": mix_sources.query,
    "op6_quality_rules": quality_rules.query,
    "op7_html_extraction": page_text.query,
    "op8_personal_data": personal_data.query,
    "op9_jaccard_join": near_copies.query,
    "op10_language_id": lang_id.query,
    "op11_conversation_trie": conversation_trie.query,
    "op12_fingerprints": sketch.query,
    "op13_merkle_manifest": merkle.query,
}

ORACLE = {
    "op1_secret_scan": secret_scan.SQL,
    "op5_mix_sources": mix_sources.SQL,
    "op6_quality_rules": quality_rules.SQL,
    "op9_jaccard_join": near_copies.SQL,
    "op11_conversation_trie": conversation_trie.SQL,
    "op12_fingerprints": sketch.SQL,
    "op13_merkle_manifest": merkle.SQL,
}
