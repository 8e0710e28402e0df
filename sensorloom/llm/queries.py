"""All queries of the subpackage."""

from sensorloom.llm import corpus_queries, page_queries, vector_queries  # noqa: F401
from sensorloom.llm.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
