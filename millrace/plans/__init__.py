"""Worked analytics, and the registry of queries over the shared tables."""

from millrace.plans import keyed, rows, streams, timed  # noqa: F401  (each registers its queries)
from millrace.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
