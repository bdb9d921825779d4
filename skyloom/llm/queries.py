"""Queries of the operators in this subpackage and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from . import decontaminate, exact_dedup, language_model, licenses, near_dedup, packing, prefix_trie, quality, sharding, token_counts, toxicity, warc, whitening

QUERIES = {
    "op1_sharding": sharding.op1_sharding,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_minhash_near_dedup": near_dedup.op3_minhash_near_dedup,
    "op4_decontamination": decontaminate.op4_decontamination,
    "op5_lm_scoring": language_model.op5_lm_scoring,
    "op6_quality": quality.op6_quality,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_license_scan": licenses.op9_license_scan,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_warc": warc.op11_warc,
    "op12_conversation_prefix_trie": prefix_trie.op12_conversation_prefix_trie,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}
SQL = {"op5_lm_scoring": language_model.SQL, "op3_minhash_near_dedup": near_dedup.SQL, "op9_license_scan": licenses.SQL, "op10_exact_dedup": exact_dedup.SQL, "op11_warc": warc.SQL, "op12_conversation_prefix_trie": prefix_trie.SQL}
