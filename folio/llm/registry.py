"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from folio.llm import byte_bpe, chat_format, exact_dedup, jaccard_join, language_id, lexical_search, packing, quality_cnn, secret_scan, token_files, topk_search, url_filter, whitening

QUERIES = {
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_topk_search": topk_search.op7_topk_search,
    "op9_quality_classifier": quality_cnn.op9_quality_classifier,
    "op1_language_id": language_id.op1_language_id,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op10_byte_bpe": byte_bpe.op10_byte_bpe,
    "op4_secret_scan": secret_scan.op4_secret_scan,
    "op2_url_filter": url_filter.op2_url_filter,
    "op3_chat_formatting": chat_format.op3_chat_formatting,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_token_files": token_files.op13_token_files,
}
ORACLES = {
    "op7_topk_search": topk_search.oracle_op7,
    "op8_exact_dedup": exact_dedup.oracle_op8,
    "op4_secret_scan": secret_scan.oracle_op4,
    "op3_chat_formatting": chat_format.oracle_op3,
    "op11_lexical_search": lexical_search.oracle_op11,
}
