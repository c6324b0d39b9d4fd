"""Registered queries: summaries and joins (queries), bars, labels and live analytics (research),
messages, archives, store, logs and streams (ingest)."""

from . import ingest, queries, research
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "ingest", "queries", "research"]
