"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from . import (
    alignment, chat, exact_dedup, jaccard_join, licenses, line_dedup, mixing, packing, pii, quality, search, substring_dedup, whitening,
)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_topk_search": search.op2_topk_search,
    "op3_exact_dedup": exact_dedup.op3_exact_dedup,
    "op4_ngram_jaccard_join": jaccard_join.op4_ngram_jaccard_join,
    "op5_quality_classifier": quality.op5_quality_classifier,
    "op6_license_scan": licenses.op6_license_scan,
    "op7_line_dedup": line_dedup.op7_line_dedup,
    "op8_mixing": mixing.op8_mixing,
    "op9_packing": packing.op9_packing,
    "op10_pii_surrogates": pii.op10_pii_surrogates,
    "op11_chat_formatting": chat.op11_chat_formatting,
    "op12_tokenizer_alignment": alignment.op12_tokenizer_alignment,
    "op13_embedding_whitening": whitening.op13_embedding_whitening,
}

ORACLE = {
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op8_mixing": mixing.ORACLE,
}
