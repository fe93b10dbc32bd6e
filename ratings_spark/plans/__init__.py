"""Jobs and the named query catalogue (importing registers every query)."""

from ratings_spark.plans import (  # noqa: F401
    offline_queries, realtime_queries, stats_queries, stream_queries)
from ratings_spark.plans.catalogue import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
