"""The registered queries: each operator over the given tables, with its SQL."""

from conform.queries import (  # noqa: F401 - importing registers the queries
    filters,
    joins,
    projections,
    protection,
    scans,
    schemas,
    sinks,
    standards,
    workflows,
)
from conform.queries.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
