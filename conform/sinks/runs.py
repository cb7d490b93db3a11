"""Loads that can be repeated: each run is a partition of its table, published at once."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.operators.columns import project_like
from conform.sinks.counting import clustered, write_counted
from conform.sinks.partitions import directories, exists, quoted, register
from conform.sinks.tables import (
    EmptyWriteError,
    SchemaMismatchError,
    described,
    partition_columns,
)
from conform.sources import empty_frame

#: The partition column that names the run, the first of its table.
RUN = "load_run"
_NAME = re.compile(r"[A-Za-z0-9_.-]+")


def save_run(
    df: DataFrame,
    table: str,
    location: str,
    run: str,
    table_format: str = "parquet",
    partitions: Sequence[str] = (),
) -> int:
    """Add the rows of one run to a table, once however often it is called.

    The table is created at ``location`` where it does not exist, with a partition
    column `RUN` before the given ones. A run is written to a folder of its name, where
    a further try starts anew; no reader sees it until the catalog gets its partitions,
    in one statement (Spark sends that in pieces of ``spark.sql.addPartitionInBatch.size``,
    and a try that ends between two of them is gone on with). The catalog's partitions
    are the ledger: a run that is there is not written again, and its rows are counted
    from the files. Names of runs have letters, digits, points, dashes and underscores.
    Meant for a single writer. Without rows raises `EmptyWriteError`.
    """
    if not _NAME.fullmatch(run):
        raise ValueError(f"{run!r} is no name for a run")
    spark, names = df.sparkSession, list(partitions)
    if not spark.catalog.tableExists(table):
        _create(df, table, location, table_format, names)
    target = spark.table(table)
    known = partition_columns(target, table)
    if known[:1] != [RUN]:
        raise SchemaMismatchError(f"{table} is not partitioned by {RUN}")
    names, about = known[1:], described(spark, table)
    path = f"{about['Location']}/{RUN}={run}"
    registered = published_partitions(spark, table, run)
    if not registered:
        given = {name.lower() for name in df.columns}
        if missing := [n for n in target.columns if n != RUN and n.lower() not in given]:
            raise SchemaMismatchError(f"{table} needs the columns {', '.join(missing)}")
        rows = write_counted(
            clustered(project_like(df, target.drop(RUN)), names),
            lambda out: out.write.format(about["Provider"])
            .mode("overwrite")
            .partitionBy(*names)
            .save(path),
        )
        if not rows:
            raise EmptyWriteError(f"no rows to save to {table}")
    if not registered or (names and exists(spark, f"{path}/_SUCCESS")):
        found = [((run,), path)]
        if names:
            schema = target.drop(RUN).schema
            folders = directories(spark, path, schema, names, about["Provider"])
            found = [((run, *values), at) for values, at in folders]
        if registered < len(found):
            register(spark, table, known, found)
            spark.catalog.refreshTable(table)
    return rows if not registered else run_rows(spark, table, run)


def published_partitions(spark: SparkSession, table: str, run: str) -> int:
    """How many partitions of a run the table has; 0 if the run was not published."""
    if not spark.catalog.tableExists(table):
        return 0
    return spark.sql(f"SHOW PARTITIONS {table} PARTITION ({RUN} = {quoted(run)})").count()


def published_runs(spark: SparkSession, table: str) -> DataFrame:
    """The ledger: the runs of a table, as the catalog has them."""
    parts = spark.sql(f"SHOW PARTITIONS {table}")
    return parts.select(F.regexp_extract("partition", f"{RUN}=([^/]*)", 1).alias(RUN)).distinct()


def run_rows(spark: SparkSession, table: str, run: str) -> int:
    """The rows of a published run."""
    return spark.table(table).where(F.col(RUN) == run).count()


def _create(
    df: DataFrame, table: str, location: str, table_format: str, names: list[str]
) -> None:
    if RUN in df.columns:
        raise SchemaMismatchError(f"the rows have a column {RUN} of their own")
    columns = df.schema
    none = empty_frame(df.sparkSession, columns).withColumn(RUN, F.lit(None).cast("string"))
    writer = none.write.format(table_format).option("path", location)
    writer.partitionBy(RUN, *names).saveAsTable(table)
