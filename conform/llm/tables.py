"""Tables between the steps of an operator, and a global order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from conform.queries.registry import scratch

BLANKS = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back.

    Later jobs start from the files, so a lost executor costs its own tasks only,
    and whatever numbers the step dealt out stay as they are.
    """
    path = scratch(df.sparkSession, name)
    # Text and hashes of it take about half the room that they take by default.
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str = "row") -> DataFrame:
    """Rows with a number of their own that every job deals out alike.

    Rows read from files are numbered by their file, in the order of the paths, and their
    place there, however many tasks read them; nothing is written but the files' names,
    which also reach every task. Other rows are numbered once and written down.
    """
    path, index, number = (free_name(df, f"_{name}_{part}") for part in ("path", "at", "file"))
    try:
        located = df.select(
            "*",
            F.col("_metadata.file_path").alias(path),
            F.col("_metadata.row_index").alias(index),
        )
        located.schema  # noqa: B018 - asks Spark whether the rows come from files
    except AnalysisException:
        return stored(df.withColumn(name, F.monotonically_increasing_id()), "numbered")
    order = Window.orderBy(path)
    files = located.select(path).distinct()
    files = files.select(path, (F.row_number().over(order) - 1).cast("long").alias(number))
    # A row for each file, of which the driver has a list anyway.
    rows = located.join(F.broadcast(stored(files, "files")), path)
    return rows.select(*df.columns, (F.shiftleft(number, 40) + F.col(index)).alias(name))


def free_name(df: DataFrame, name: str) -> str:
    """A name that no column has, made of the given one."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def ordered(df: DataFrame, keys: Sequence[str], size: str | None = None) -> DataFrame:
    """Rows with their place in the order of ``keys`` over the whole table.

    Adds ``place`` (from 0, gapless) and ``places`` (how many rows there are); with
    ``size``, a column of whole numbers, also ``before`` (sum of the sizes of all
    earlier rows) and ``total``. Spark deals the rows out in ranges, each range
    counts by itself, and one row for each range meets in a single task. Rows equal
    in all keys get places next to each other; pass columns that tell rows apart.
    """
    sums = [F.count("*").alias("_rows")] + ([F.sum(size).alias("_size")] if size else [])
    dealt = stored(
        df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ordered"
    )
    up_to = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )

    def earlier(column: str):
        return F.coalesce(F.sum(column).over(up_to), F.lit(0))

    starts = dealt.groupBy("_part").agg(*sums)
    starts = starts.select(
        F.col("_part").alias("_start_part"),
        earlier("_rows").alias("_rows_before"),
        F.sum("_rows").over(everything).alias("places"),
        *(
            [earlier("_size").alias("_size_before"), F.sum("_size").over(everything).alias("total")]
            if size
            else []
        ),
    )
    inside = Window.partitionBy("_part").orderBy(*keys)
    rows = dealt.withColumn("_inside", F.row_number().over(inside) - 1)
    if size:
        running = inside.rowsBetween(Window.unboundedPreceding, 0)
        rows = rows.withColumn("_running", F.sum(size).over(running) - F.col(size))
    # A row for each range at most, and ranges are as many as shuffle partitions.
    rows = rows.join(F.broadcast(starts), F.col("_part") == F.col("_start_part"))
    kept = [*df.columns, (F.col("_rows_before") + F.col("_inside")).alias("place"), "places"]
    if size:
        kept += [(F.col("_size_before") + F.col("_running")).alias("before"), "total"]
    return rows.select(*kept)
