"""The queries of this package and their DuckDB equivalents, by name."""

from __future__ import annotations

from pairquarry.llm import bpe, chat, exact_dedup, manifest, mixing, periodic_runs, quality, simhash, substrings, token_counts, topk, toxicity, wrappers

QUERIES = {
    "op1_token_counts": token_counts.op1_token_counts,
    "op2_chat_formatting": chat.op2_chat_formatting,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_simhash_near_dedup": simhash.op4_simhash_near_dedup,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_exact_dedup": exact_dedup.op6_exact_dedup,
    "op7_html_extraction": wrappers.op7_html_extraction,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_exact_topk": topk.op9_exact_topk,
    "op10_bpe_encode_decode": bpe.op10_bpe_encode_decode,
    "op11_quality_rules": quality.op11_quality_rules,
    "op12_merkle_manifest": manifest.op12_merkle_manifest,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {
    "op2_chat_formatting": chat.ORACLE,
    "op5_mix_sources": mixing.ORACLE,
    "op6_exact_dedup": exact_dedup.ORACLE,
    "op9_exact_topk": topk.ORACLE,
    "op12_merkle_manifest": manifest.ORACLE,
}
