"""All queries on the benchmark tables. Importing the modules registers their queries."""

from cladegrid.plans import element_queries, membership_queries, quality_queries, statistics_queries  # noqa: F401
from cladegrid.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
