"""Registered queries of the subpackage and their DuckDB SQL."""

from __future__ import annotations

from . import (alignment, bpe, decontaminate, fingerprints, html_extract, lang_id, quality, similarity_join,
               spelling, substring_dedup, token_files, toxicity, vector_search)

QUERIES = {
    "op1_fingerprints": fingerprints.op1_fingerprints,
    "op2_token_files": token_files.op2_token_files,
    "op3_quality": quality.op3_quality,
    "op4_html_text": html_extract.op4_html_text,
    "op5_similarity_join": similarity_join.op5_similarity_join,
    "op6_decontaminate": decontaminate.op6_decontaminate,
    "op7_substring_dedup": substring_dedup.op7_substring_dedup,
    "op8_bpe": bpe.op8_bpe,
    "op9_language_id": lang_id.op9_language_id,
    "op10_toxicity": toxicity.op10_toxicity,
    "op11_spelling_variants": spelling.op11_spelling_variants,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_nearest_vectors": vector_search.op13_nearest_vectors,
}

ORACLES = {
    "op5_similarity_join": similarity_join.ORACLE,
    "op6_decontaminate": decontaminate.ORACLE,
    "op7_substring_dedup": substring_dedup.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
}
