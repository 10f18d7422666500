"""Every registered query and its DuckDB counterpart."""

from __future__ import annotations

from gridsight.plans import detections, reviews, scalars  # noqa: F401  they register their queries
from gridsight.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
