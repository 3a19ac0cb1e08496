"""Runnable queries over the driver's tables, one per operator, most with a SQL oracle."""

from catalog import aggregates, cleaning, clusters, features, joins, learning, monitoring, sources, splits  # noqa: F401
from catalog.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
