"""Operators of a training-data pipeline and their registered queries.

Nothing else in the library imports this subpackage. Each module holds one operator
with its general interface, one query ``opN_<name>`` over the driver tables and, where
SQL can express it, ``ORACLE``: the SQL of the same rows.
"""

from __future__ import annotations

import importlib

OPERATORS = {
    "op1_substring_dedup": "substring",
    "op2_mixing_weights": "mixing",
    "op3_url_filter": "url_reputation",
    "op4_token_rollup": "token_rollup",
    "op5_toxicity": "toxicity",
    "op6_exact_dedup": "exact_dedup",
    "op7_ngram_jaccard": "ngram_jaccard",
    "op8_edit_fingerprint": "edit_fingerprint",
    "op9_byte_bpe": "byte_bpe",
    "op10_language_id": "language_id",
    "op11_target_resampling": "target_resampling",
    "op12_periodic_runs": "periodic_runs",
    "op13_vector_near": "vector_near",
}


def all_queries() -> tuple[dict, dict]:
    """Queries by name, called with (spark, sf_dir), and the SQL of those that have one."""
    queries, oracles = {}, {}
    for name, module in OPERATORS.items():
        loaded = importlib.import_module(f"carelake.llm.{module}")
        queries[name] = getattr(loaded, name)
        if getattr(loaded, "ORACLE", None):
            oracles[name] = loaded.ORACLE
    return queries, oracles
