"""The corpus pipeline as a query."""

from __future__ import annotations

import corpus_pipeline

QUERIES = {"pipeline": corpus_pipeline.run}
ORACLE = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
