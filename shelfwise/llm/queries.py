"""Registered queries of the training-data operators and their SQL (the entry
point adds the pipeline, which calls the operators)."""

from __future__ import annotations

from . import decontaminate, langid, neighbours, ngram_join, packing, pii, preferences, sharding, spelling, substrings, toxicity, urls, whitening

QUERIES = {
    "op1_url_filters": urls.query,
    "op2_best_fit_packing": packing.query,
    "op3_substring_dedup": substrings.query,
    "op4_chat_formatting": preferences.query,
    "op5_language_id": langid.query,
    "op6_pii": pii.query,
    "op7_ngram_jaccard_join": ngram_join.query,
    "op8_nearest_neighbours": neighbours.query,
    "op9_toxicity": toxicity.query,
    "op10_decontamination": decontaminate.query,
    "op11_embedding_whitening": whitening.query,
    "op12_spelling_variants": spelling.query,
    "op13_sharding": sharding.query,
}

SQL = {
    "op1_url_filters": urls.SQL,
    "op4_chat_formatting": preferences.SQL,
}
