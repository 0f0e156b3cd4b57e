"""All queries of the engine over the driver's tables."""

from civicframe.plans import graph_queries, location_queries, meeting_queries, quality_queries, record_queries
from civicframe.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "graph_queries", "location_queries", "meeting_queries", "quality_queries", "record_queries"]
