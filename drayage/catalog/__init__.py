"""The registered queries and their SQL counterparts."""

from drayage.catalog import logs, runs, transfer  # noqa: F401  (registers the queries)
from drayage.catalog.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
