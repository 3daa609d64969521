"""All queries over the driver's tables, and their SQL."""

from __future__ import annotations

from tidemark.plans import scans, streams  # noqa: F401  they register their queries
from tidemark.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
