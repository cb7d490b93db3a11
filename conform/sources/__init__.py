"""Where DataFrames come from: delimited files, rows in memory, catalog tables."""

from conform.sources.delimited import (
    TooManyRejectedError,
    read_delimited,
    read_delimited_by_header,
    read_delimited_checked,
    refuse_rejected,
)
from conform.sources.rows import empty_frame, rows_frame
from conform.sources.tables import kept, read_table, read_table_or_empty, run_sql, table_exists

__all__ = [
    "TooManyRejectedError",
    "empty_frame",
    "kept",
    "read_delimited",
    "read_delimited_by_header",
    "read_delimited_checked",
    "read_table",
    "read_table_or_empty",
    "refuse_rejected",
    "rows_frame",
    "run_sql",
    "table_exists",
]
