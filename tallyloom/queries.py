"""All queries of the library but those of the training-data operators."""

from __future__ import annotations

from tallyloom.plans import live_queries, log_queries, media_queries, more_queries, queue_queries, row_queries, rule_queries, source_queries, stats_queries  # noqa: F401
from tallyloom.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
