"""Queries and reference SQL of the training-data operators."""

from __future__ import annotations

import importlib

MODULES = ["url_filter", "suffix_dedup", "exact_dedup", "gif_media", "minhash_dedup", "warc", "quality", "bpe", "mixing", "line_dedup", "vector_codes", "token_alignment", "license_scan", "pipeline_query"]


def _modules():
    return [importlib.import_module(f"tallyloom.llm.{m}") for m in MODULES]


def queries() -> dict:
    return {k: f for m in _modules() for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in _modules() for k, s in getattr(m, "ORACLE", {}).items()}
