"""Queries of the corpus operators, and SQL for those that SQL can express."""

from __future__ import annotations

import importlib

_QUERIES = {
    "op1_license_scan": "license_scan",
    "op2_simhash_dedup": "simhash_dedup",
    "op3_url_trust": "url_trust",
    "op4_quality_divergence": "quality_divergence",
    "op5_doubling_dedup": "doubling_dedup",
    "op6_secret_scan": "secret_scan",
    "op7_source_mixing": "source_mixing",
    "op8_decontamination": "decontamination",
    "op9_bwt_dedup": "bwt_dedup",
    "op10_class_lm": "class_lm",
}


def _module(name: str):
    return importlib.import_module(f"{__package__}.{_QUERIES[name]}")


def queries() -> dict:
    import corpus_pipeline

    return {**{name: getattr(_module(name), name) for name in _QUERIES}, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name in _QUERIES if (sql := getattr(_module(name), "SQL", None))}
