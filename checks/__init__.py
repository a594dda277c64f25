"""Queries over the given tables and the SQL they are checked against."""

from checks import cleaning_queries, evaluation_queries, model_queries, offer_queries, sales_queries, table_queries  # noqa: F401
from checks.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
