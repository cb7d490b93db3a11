"""Catalog tables: save, insert, and a move that checks schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from conform.operators.columns import project_like
from conform.operators.schema import same_schema
from conform.sinks.counting import clustered, write_counted


class EmptyWriteError(ValueError):
    """There were no rows to write."""


class SchemaMismatchError(ValueError):
    """The rows do not fit the table they should go to."""


def save(
    df: DataFrame,
    table: str,
    location: str,
    table_format: str = "parquet",
    partitions: Sequence[str] = (),
) -> int:
    """Append to a table; create it at ``location`` where it does not exist.

    Returns the rows written. Without any, a table created here is dropped
    again and `EmptyWriteError` is raised.
    """
    spark = df.sparkSession
    names = list(partitions)
    exists = spark.catalog.tableExists(table)

    def write(out: DataFrame) -> None:
        writer = out.write.format(table_format).mode("append")
        if not exists:
            writer = writer.option("path", location)
        if names:
            writer = writer.partitionBy(*names)
        writer.saveAsTable(table)

    rows = write_counted(clustered(df, names), write)
    if not rows:
        if not exists:
            spark.sql(f"DROP TABLE {table}")
        raise EmptyWriteError(f"no rows to save to {table}")
    return rows


def insert(df: DataFrame, table: str, drop_others: bool = False) -> int:
    """Append to an existing table, matching columns by name.

    Columns that the table lacks are refused unless ``drop_others`` leaves them out.
    Returns the rows written; without any, raises `EmptyWriteError`.
    """
    target = df.sparkSession.table(table)
    given = {name.lower() for name in df.columns}
    missing = [name for name in target.columns if name.lower() not in given]
    if missing:
        raise SchemaMismatchError(f"{table} needs the columns {', '.join(missing)}")
    known = {name.lower() for name in target.columns}
    others = [name for name in df.columns if name.lower() not in known]
    if others and not drop_others:
        raise SchemaMismatchError(f"{table} has no columns {', '.join(others)}")
    arranged = _arranged(project_like(df, target), table)
    rows = write_counted(arranged, lambda out: out.write.insertInto(table))
    if not rows:
        raise EmptyWriteError(f"no rows to insert into {table}")
    return rows


def move(
    df: DataFrame,
    table: str,
    location: str,
    table_format: str = "parquet",
    partitions: Sequence[str] = (),
    strict: bool = True,
) -> int:
    """Insert into a table of the same schema, or create it.

    ``strict`` also compares nullability, see `same_schema`. A table has its
    partition columns last, wherever they are among the rows' columns.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return save(df, table, location, table_format, partitions)
    last = [name for name in partition_columns(df, table) if name in df.columns]
    df = df.select(*(f"`{name}`" for name in df.columns if name not in last), *last)
    if not same_schema(spark.table(table).schema, df.schema, strict):
        raise SchemaMismatchError(f"the schema of the rows is not that of {table}")
    return insert(df, table)


def _arranged(df: DataFrame, table: str) -> DataFrame:
    """The rows of an output partition or bucket together, to write few files.

    Spark splits a bucket that is too large for a task into several files.
    """
    buckets = [c.name for c in df.sparkSession.catalog.listColumns(table) if c.isBucket]
    if not buckets:
        return clustered(df, partition_columns(df, table))
    count = described(df.sparkSession, table)["Num Buckets"]
    return df.hint("rebalance", int(count), *buckets)


def described(spark: SparkSession, table: str) -> dict[str, str]:
    """What the catalog says of a table, beside its columns."""
    rows = spark.sql(f"DESCRIBE EXTENDED {table}").collect()
    starts = [n for n, row in enumerate(rows) if row["col_name"].startswith("# Detailed")]
    return {row["col_name"]: row["data_type"] for row in rows[starts[-1] :]}


def partition_columns(df: DataFrame, table: str) -> list[str]:
    columns = df.sparkSession.catalog.listColumns(table)
    return [column.name for column in columns if column.isPartition]
