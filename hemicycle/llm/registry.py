"""Corpus queries and their SQL counterparts."""

from __future__ import annotations

from . import queries
from .queries import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "queries"]
