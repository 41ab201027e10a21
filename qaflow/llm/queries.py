"""The registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from qaflow.llm import ann_tree, decontam, jaccard_join, language_id, linededup, packing, prefix_trie, quality, secret_scan, spelling_variants, substring_dedup, warc, wrapper_html

QUERIES = {
    "op1_quality": quality.query,
    "op2_warc": warc.query,
    "op3_decontamination": decontam.query,
    "op4_best_fit_packing": packing.query,
    "op5_line_dedup": linededup.query,
    "op6_secret_scan": secret_scan.query,
    "op7_ngram_jaccard_join": jaccard_join.query,
    "op8_wrapper_html": wrapper_html.query,
    "op9_ann_tree": ann_tree.query,
    "op10_substring_dedup": substring_dedup.query,
    "op11_spelling_variants": spelling_variants.query,
    "op12_language_id": language_id.query,
    "op13_prefix_trie": prefix_trie.query,
}
ORACLES = {"op2_warc": warc.SQL, "op5_line_dedup": linededup.SQL, "op11_spelling_variants": spelling_variants.SQL, "op13_prefix_trie": prefix_trie.SQL}
