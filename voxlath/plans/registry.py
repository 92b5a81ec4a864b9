"""Queries of the curation and evaluation engine, and SQL that gives the same rows."""

from __future__ import annotations

from . import corpus_queries, extra_queries, frame_queries, measure_queries, study_queries

_PARTS = (frame_queries, corpus_queries, extra_queries, study_queries, measure_queries)
QUERIES: dict = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLES: dict[str, str] = {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
