"""Set a flag on rows of a table whose files cannot be changed in place."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.operators.joins import equi_join
from conform.sinks.counting import clustered, write_counted
from conform.sinks.partitions import moved, quoted, swap
from conform.sinks.tables import described, partition_columns

_MEETS = "__meets"


def flagged(
    df: DataFrame, condition: Column | str, flag: str = "flag", value: str = "1"
) -> DataFrame:
    """Set ``flag`` where ``condition`` holds; other rows keep theirs."""
    meets = F.expr(condition) if isinstance(condition, str) else condition
    mark = F.lit(value).cast(df.select(flag).schema[0].dataType)
    return df.withColumn(flag, F.when(meets, mark).otherwise(F.col(flag)))


def update_flag(
    spark: SparkSession,
    table: str,
    condition: Column | str,
    location: str,
    flag: str = "flag",
    value: str = "1",
    table_format: str = "parquet",
    among: Sequence[tuple[str, DataFrame]] = (),
    resume: bool = False,
) -> int:
    """Set ``flag`` on the rows of a table that meet ``condition``.

    ``among`` gives columns with a frame of one column each: only rows whose value is
    in it are flagged.

    Of a partitioned table the partitions with such rows are written again: to
    ``location``, where the table is then pointed at them, see `swap`, or in place if
    that is empty. Where the flag itself partitions the table its rows move, which
    takes a location: partitions left and partitions entered are written whole, and those
    left empty are dropped. Another table is written anew to ``location``, which must be
    unused, and the table is then pointed there; its old files stay.

    With ``resume`` the location names the update: a call that failed can be repeated
    with it, and one that had ended does nothing. Returns the rows written. Meant for a
    single writer.
    """
    source = spark.table(table)
    names = partition_columns(source, table)
    marked = _marked(source, condition, among)
    if names and location:
        if flag in names:
            return _moved(spark, table, marked, flag, value, names, location)
        affected = _affected(marked, F.col(_MEETS), names)
        updated = flagged(affected, F.col(_MEETS), flag, value).select(*source.columns)
        return swap(updated, table, location)
    if flag in names:
        raise ValueError(f"{flag} is a partition column of {table}; its rows need a location")
    if names and moved(spark, table):
        raise ValueError(f"partitions of {table} lie outside of its folder; give a location")
    if not names:
        if resume and _same_place(described(spark, table)["Location"], location):
            return 0
        rows = write_counted(
            flagged(marked, F.col(_MEETS), flag, value).select(*source.columns),
            lambda out: out.write.format(table_format)
            .mode("overwrite" if resume else "error")
            .save(location),
        )
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(location)}")
    else:
        affected = _affected(marked, F.col(_MEETS), names)
        updated = flagged(affected, F.col(_MEETS), flag, value).select(*source.columns)
        rows = write_counted(
            clustered(updated, names), lambda out: _replace_partitions(out, table, names)
        )
    spark.catalog.refreshTable(table)
    return rows


def _marked(
    source: DataFrame, condition: Column | str, among: Sequence[tuple[str, DataFrame]]
) -> DataFrame:
    """The rows with a column that says which to flag."""
    meets = F.expr(condition) if isinstance(condition, str) else condition
    df = source.withColumn(_MEETS, F.coalesce(meets, F.lit(False)))
    for number, (column, values) in enumerate(among):
        key, known = f"__value{number}", f"__known{number}"
        listed = values.toDF(key).where(F.col(key).isNotNull()).distinct()
        df = equi_join(df, listed.withColumn(known, F.lit(True)), [(column, key)], "left")
        df = df.withColumn(_MEETS, F.col(_MEETS) & F.coalesce(known, F.lit(False)))
        df = df.drop(key, known)
    return df


def _affected(source: DataFrame, condition: Column | str, names: list[str]) -> DataFrame:
    """The partitions that have rows which meet the condition, whole.

    They stay a table of their own, so nothing of them goes through the driver, and
    all partition columns together say which they are. Nulls are matched apart, as
    equality alone lets Spark prune the scan.
    """
    return _within(source, source.where(condition).select(*names).distinct(), names)


def _within(source: DataFrame, touched: DataFrame, names: list[str]) -> DataFrame:
    some_null = reduce(or_, (F.col(name).isNull() for name in names))
    whole = source.where(~some_null).join(touched.where(~some_null), names, "left_semi")
    left, right = source.where(some_null).alias("l"), touched.where(some_null).alias("r")
    same = reduce(and_, (F.col(f"l.`{n}`").eqNullSafe(F.col(f"r.`{n}`")) for n in names))
    partly = left.join(right, same, "left_semi")
    return whole.select(*source.columns).unionByName(partly)


def _moved(
    spark: SparkSession,
    table: str,
    marked: DataFrame,
    flag: str,
    value: str,
    names: list[str],
    location: str,
) -> int:
    """Write anew all partitions that rows leave or enter, and swap them in.

    Rows that have the flag already move nowhere, so a partition of them only stays.
    """
    source = spark.table(table)
    new = F.lit(value).cast(source.schema[flag].dataType)
    moving = marked.where(F.col(_MEETS) & ~F.col(flag).eqNullSafe(new)).select(*names).distinct()
    entered = moving.withColumn(flag, new).distinct()
    closure = moving.unionByName(entered).distinct()
    affected = _within(marked, closure, names)
    updated = flagged(affected, F.col(_MEETS), flag, value).select(*source.columns)
    return swap(updated, table, location, touched=moving)


def _replace_partitions(df: DataFrame, table: str, names: list[str]) -> None:
    """Write to the table's own folder: there the mode is the write's, not the session's."""
    about = described(df.sparkSession, table)
    writer = df.write.format(about["Provider"]).mode("overwrite").partitionBy(*names)
    writer.option("partitionOverwriteMode", "dynamic").save(about["Location"])


def _same_place(one: str, other: str) -> bool:
    """Whether two paths agree, but for the file system that one may leave out."""
    paths = [path.split(":", 1)[-1].strip("/") for path in (one, other)]
    return paths[0] == paths[1]
