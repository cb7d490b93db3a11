"""Partitioned Parquet directories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from conform.sinks.counting import clustered, write_counted
from conform.sinks.settings import preset

#: Files that a task has open at once. With one file at a time Spark first sorts a task's
#: rows by the partition; with some it sorts only rows of further partitions.
WRITERS = {"spark.sql.maxConcurrentOutputFileWriters": "4"}


def write_partitioned(
    df: DataFrame, path: str, partitions: Sequence[str], cluster: bool = True
) -> int:
    """Overwrite ``path`` with Parquet, one directory per partition value.

    ``cluster=False`` saves the shuffle; every task then writes a file for
    every partition it holds, which suits few partition values.
    """
    names = list(partitions)
    with preset(df.sparkSession, WRITERS):
        return write_counted(
            clustered(df, names) if cluster else df,
            lambda out: out.write.mode("overwrite").partitionBy(*names).parquet(path),
        )


def overwrite_partitions(
    df: DataFrame, path: str, partitions: Sequence[str], cluster: bool = True
) -> int:
    """Replace only the partitions that ``df`` has rows for."""
    names = list(partitions)
    with preset(df.sparkSession, WRITERS):
        return write_counted(
            clustered(df, names) if cluster else df,
            lambda out: out.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*names)
            .parquet(path),
        )
