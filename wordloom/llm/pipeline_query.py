"""The query ``pipeline``: the stages of ``corpus_pipeline`` over documents."""

from __future__ import annotations

import corpus_pipeline

QUERIES: dict = {"pipeline": corpus_pipeline.run}
ORACLES: dict[str, str] = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
