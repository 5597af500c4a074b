"""Registered queries: every operator applied to the given star-schema tables, each with
the SQL that states the same result."""

from landfall.workloads import (
    flows,
    joins,
    quality,
    questions,
    shaping,
    storage,
    streams,
    summaries,
    temporal,
    versions,
)
from landfall.workloads.registry import oracle_sql, queries

__all__ = [
    "flows",
    "joins",
    "oracle_sql",
    "quality",
    "queries",
    "questions",
    "shaping",
    "storage",
    "streams",
    "summaries",
    "temporal",
    "versions",
]
