"""All registered queries."""

from __future__ import annotations

from curbflow.checks import lifting_queries, rollup_queries, sweeping_queries, trip_queries  # noqa: F401
from curbflow.checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
