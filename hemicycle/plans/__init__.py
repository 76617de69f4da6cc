"""Queries over the given tables."""

from . import analysis_queries, graph_queries, model_queries, series_queries, source_queries, text_queries
from .registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "analysis_queries",
    "graph_queries",
    "model_queries",
    "series_queries",
    "source_queries",
    "text_queries",
]
