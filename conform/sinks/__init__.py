"""Writers. Each runs one job and tells how many rows it wrote."""

from conform.sinks.casts import CastCounts, WrittenCast, write_casts
from conform.sinks.files import overwrite_partitions, write_partitioned
from conform.sinks.flags import flagged, update_flag
from conform.sinks.partitions import replace_partitions
from conform.sinks.runs import RUN, published_runs, save_run
from conform.sinks.tables import EmptyWriteError, SchemaMismatchError, insert, move, save
from conform.sinks.vault import compact_vault, create_vault

__all__ = [
    "RUN",
    "CastCounts",
    "EmptyWriteError",
    "SchemaMismatchError",
    "WrittenCast",
    "compact_vault",
    "create_vault",
    "flagged",
    "insert",
    "move",
    "overwrite_partitions",
    "published_runs",
    "replace_partitions",
    "save",
    "save_run",
    "update_flag",
    "write_casts",
    "write_partitioned",
]
