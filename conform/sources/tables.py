"""Catalog tables and SQL text over views."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import StructType

from conform.sources.rows import empty_frame


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(table)


def read_table(
    spark: SparkSession, table: str, condition: Column | str | None = None
) -> DataFrame:
    """Read a catalog table, keeping the rows that meet ``condition``.

    The condition is a predicate only, so it reaches the scan as a pushed
    filter. A missing table raises ``AnalysisException``. Nothing is cached.
    """
    frame = spark.table(table)
    return frame if condition is None else frame.where(condition)


def read_table_or_empty(
    spark: SparkSession, table: str, schema: StructType | str
) -> DataFrame:
    """Read a catalog table, or no rows with ``schema`` where it does not exist."""
    if table_exists(spark, table):
        return spark.table(table)
    return empty_frame(spark, schema)


def run_sql(spark: SparkSession, query: str, **frames: DataFrame) -> DataFrame:
    """Run SQL text in which ``{name}`` stands for the DataFrame ``name``."""
    return spark.sql(query, **frames)


@contextmanager
def kept(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """Keep a frame's rows for the actions inside of a ``with``, and then let them go.

    They stay on the executors; what a lost one held is worked out again from the sources,
    which must not change meanwhile. Nothing stays behind, after an error neither.
    """
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist(blocking=True)
