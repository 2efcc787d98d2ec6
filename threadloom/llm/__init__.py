"""Operators of a training-data pipeline. Nothing else in the library imports this subpackage."""

from __future__ import annotations

from . import bpe, class_models, embedding_dedup, fingerprints, lexical_search, licenses, mixing, ngram_join, quality, sequenced_changes, substring_dedup, token_counts, toxicity, warc

QUERIES = {
    "op1_embedding_near_dedup": embedding_dedup.op1_embedding_near_dedup,
    "op2_toxicity": class_models.op2_toxicity,
    "op3_substring_dedup": substring_dedup.op3_substring_dedup,
    "op4_quality_classifier": quality.op4_quality_classifier,
    "op5_document_fingerprints": fingerprints.op5_document_fingerprints,
    "op6_bpe": bpe.op6_bpe,
    "op7_warc": warc.op7_warc,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_mixing": mixing.op9_mixing,
    "op10_ngram_jaccard_join": ngram_join.op10_ngram_jaccard_join,
    "op11_lexical_search": lexical_search.op11_lexical_search,
    "op12_token_counts": token_counts.op12_token_counts,
    "op13_sequenced_changes": sequenced_changes.op13_sequenced_changes,
}
ORACLE_SQL: dict[str, str] = {
    "op5_document_fingerprints": fingerprints.ORACLE_SQL,
    "op7_warc": warc.ORACLE_SQL,
    "op9_mixing": mixing.ORACLE_SQL,
    "op11_lexical_search": lexical_search.ORACLE_SQL,
}
