"""The registered queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from . import embedding_dedup, exact_search, jaccard_join, language_id, lm_scoring, mixing, packing, periodic_runs, pii_boost, spelling_groups, substring_dedup, token_counts, url_filters

QUERIES = {
    "op1_language_id": language_id.op1,
    "op2_best_fit_packing": packing.op2,
    "op3_separator_scan": token_counts.op3,
    "op4_pivot_search": exact_search.op4,
    "op5_prefix_tree_join": jaccard_join.op5,
    "op6_url_filters": url_filters.op6,
    "op7_backoff_scores": lm_scoring.op7,
    "op8_recompression_dedup": substring_dedup.op8,
    "op9_embedding_near_dedup": embedding_dedup.op9,
    "op10_source_mixing": mixing.op10,
    "op11_periodic_runs": periodic_runs.op11,
    "op12_pii_boost": pii_boost.op12,
    "op13_spelling_groups": spelling_groups.op13,
}

ORACLE = {
    "op4_pivot_search": exact_search.SQL,
    "op5_prefix_tree_join": jaccard_join.SQL,
    "op6_url_filters": url_filters.SQL,
    "op7_backoff_scores": lm_scoring.SQL,
    "op8_recompression_dedup": substring_dedup.SQL,
    "op9_embedding_near_dedup": embedding_dedup.SQL,
    "op10_source_mixing": mixing.SQL,
    "op11_periodic_runs": periodic_runs.SQL,
    "op13_spelling_groups": spelling_groups.SQL,
}
