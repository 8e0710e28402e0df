"""Whole plans and the registered queries."""

from sensorloom.plans import (  # noqa: F401
    audit_queries,
    cloud_queries,
    live_queries,
    raster_queries,
    series_queries,
    storage_queries,
    sync_queries,
    tree_queries,
    type_queries,
)
from sensorloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
