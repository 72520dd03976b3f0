"""Operators of a training-data pipeline. Nothing else in the package imports this subpackage."""

from streamlytics.llm import catalog  # noqa: F401  (registers the queries)
from streamlytics.llm.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
