"""All registered queries."""

from quirelake.plans import (  # noqa: F401
    column_queries,
    curation_queries,
    frontier_queries,
    rerun_queries,
    storage_queries,
    view_queries,
)
from quirelake.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
