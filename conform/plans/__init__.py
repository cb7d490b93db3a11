"""Whole loads, and the record of their runs."""

from conform.plans.audit import AUDIT_SCHEMA, AuditRun, RunFailed
from conform.plans.clients import client_product, ingest
from conform.plans.protected import LoadResult, protected_load

__all__ = [
    "AUDIT_SCHEMA",
    "AuditRun",
    "LoadResult",
    "RunFailed",
    "client_product",
    "ingest",
    "protected_load",
]
