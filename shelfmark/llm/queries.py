"""The queries of the numbered operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from shelfmark.llm import bpe, chaining, content_store, decontaminate, divergence, exact, licenses, negatives, packing, quality, secret_scan, simhash, suffix

QUERIES = {
    "op1_suffix_array_dedup": suffix.op1_suffix_array_dedup,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op3_packing": packing.op3_packing,
    "op4_substring_dedup": chaining.op4_substring_dedup,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_content_store": content_store.op6_content_store,
    "op7_exact_dedup": exact.op7_exact_dedup,
    "op8_secret_scan": secret_scan.op8_secret_scan,
    "op9_simhash_near_dedup": simhash.op9_simhash_near_dedup,
    "op10_license_scan": licenses.op10_license_scan,
    "op11_hard_negatives": negatives.op11_hard_negatives,
    "op12_bpe_round_trip": bpe.op12_bpe_round_trip,
    "op13_source_divergence": divergence.op13_source_divergence,
}

SQL = {
    "op7_exact_dedup": exact.OP7_SQL,
    "op11_hard_negatives": negatives.OP11_SQL,
    "op13_source_divergence": divergence.OP13_SQL,
}
