"""All registered queries: importing the query modules fills the registry."""

from __future__ import annotations

from . import evaluation_queries, history_queries, ingest_queries, matrix_queries, model_queries, reader_queries  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
