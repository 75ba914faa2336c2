"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from strata.llm import conversation_repair, exact_dedup, html_text, language, mixing, packing, piecewise_hash, quality, simhash_dedup, substring_dedup, topk_search, url_filter, vector_codes

QUERIES = {
    "op8_topk_search": topk_search.op8_topk_search,
    "op3_url_filter": url_filter.op3_url_filter,
    "op10_html_extraction": html_text.op10_html_extraction,
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_mix_sources": mixing.op2_mix_sources,
    "op4_simhash_dedup": simhash_dedup.op4_simhash_dedup,
    "op5_quality_classifier": quality.op5_quality_classifier,
    "op6_language_id": language.op6_language_id,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op9_best_fit_packing": packing.op9_best_fit_packing,
    "op11_document_fingerprints": piecewise_hash.op11_document_fingerprints,
    "op12_conversation_repair": conversation_repair.op12_conversation_repair,
    "op13_vector_codes": vector_codes.op13_vector_codes,
}
ORACLES = {
    "op8_topk_search": topk_search.ORACLE,
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op2_mix_sources": mixing.ORACLE,
    "op6_language_id": language.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op12_conversation_repair": conversation_repair.ORACLE,
    "op13_vector_codes": vector_codes.ORACLE,
}
