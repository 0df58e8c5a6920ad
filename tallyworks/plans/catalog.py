"""All registered queries."""

from tallyworks.plans import (  # noqa: F401  (importing registers the queries)
    log_queries,
    placement_queries,
    retail_queries,
    sketch_queries,
    storage_queries,
    timeline_queries,
)
from tallyworks.plans.registry import QUERIES, Query

__all__ = ["QUERIES", "Query"]
