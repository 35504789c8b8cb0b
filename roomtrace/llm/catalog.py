"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from roomtrace.llm import (
    chat,
    decontaminate,
    disguises,
    html_cut,
    licenses,
    ngram_join,
    packing,
    quality_gam,
    quality_rules,
    spelling,
    token_files,
    trie_bpe,
    turn_repair,
)

QUERIES = {
    "op1_ngram_join": ngram_join.op1_ngram_join,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_token_files": token_files.op3_token_files,
    "op4_quality_gam": quality_gam.op4_quality_gam,
    "op5_html_cut": html_cut.op5_html_cut,
    "op6_sharding": packing.op6_sharding,
    "op7_bpe": trie_bpe.op7_bpe,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_chat_formatting": chat.op10_chat_formatting,
    "op11_turn_repair": turn_repair.op11_turn_repair,
    "op12_disguised_pii": disguises.op12_disguised_pii,
    "op13_spelling_variants": spelling.op13_spelling_variants,
}

ORACLE = {
    "op1_ngram_join": ngram_join.OP1_SQL,
    "op2_decontamination": decontaminate.OP2_SQL,
    "op8_license_scan": licenses.OP8_SQL,
    "op9_quality_rules": quality_rules.OP9_SQL,
    "op10_chat_formatting": chat.OP10_SQL,
    "op13_spelling_variants": spelling.OP13_SQL,
}
