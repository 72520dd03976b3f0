"""Named queries over the driver's tables, each with the SQL that states the same result."""

from streamlytics.catalog import batch, streams  # noqa: F401  (registers the queries)
from streamlytics.catalog.registry import oracle_sql, queries

__all__ = ["oracle_sql", "queries"]
