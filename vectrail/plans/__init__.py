"""Registered queries: each operator over the given tables, with its check in SQL."""

from __future__ import annotations

from vectrail.plans import (  # noqa: F401
    analytics,
    embedding,
    profiles,
    relational,
    scalars,
    scans,
    searches,
    text_lexing,
    vectors,
)
from vectrail.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
