"""Registered queries of the text operators and their SQL twins."""

from __future__ import annotations

from contactloom.llm import chat_format, fingerprint, ngram_join, packing, periodic_runs, pieces, pitman_yor, quality_rules, secret_scan, suffix_dedup, token_align, toxicity, url_filter
from contactloom.llm.oracle import ORACLE  # noqa: F401

QUERIES: dict = {
    "op1_secret_scans": secret_scan.query,
    "op2_best_fit_packing": packing.query,
    "op3_url_filters": url_filter.query,
    "op4_ngram_jaccard_join": ngram_join.query,
    "op5_quality_rules": quality_rules.query,
    "op6_suffix_dedup": suffix_dedup.query,
    "op7_chat_formatting": chat_format.query,
    "op8_piece_encoding": pieces.query,
    "op9_fingerprints": fingerprint.query,
    "op10_lm_scoring": pitman_yor.query,
    "op11_toxicity": toxicity.query,
    "op12_token_alignment": token_align.query,
    "op13_periodic_runs": periodic_runs.query,
}
