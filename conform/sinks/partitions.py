"""Partitions of catalog tables, replaced by pointing the table at new files."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conform.operators.columns import project_like
from conform.sinks.counting import clustered, write_counted
from conform.sinks.tables import SchemaMismatchError, described, partition_columns

#: The property of a table whose partitions may lie outside of its folder.
MOVED = "conform.moved"

_ROWS, _LEFT = "rows", "left"


def replace_partitions(df: DataFrame, table: str, location: str) -> int:
    """Replace the partitions of a table that ``df`` has rows for, and register new ones.

    The rows are written to ``location``, by partition, and the table is then pointed
    there; no other partition is touched, nor any setting of the session. ``df`` may be
    made of the table itself, as its old files stay. ``location`` names the replacement:
    a second call with it finishes what the first had begun and writes nothing anew, so a
    call that failed can be repeated. Meant for a single writer. Returns the rows written.
    """
    target = df.sparkSession.table(table)
    given = {name.lower() for name in df.columns}
    if missing := [name for name in target.columns if name.lower() not in given]:
        raise SchemaMismatchError(f"{table} needs the columns {', '.join(missing)}")
    return swap(project_like(df, target), table, location)


def swap(df: DataFrame, table: str, location: str, touched: DataFrame | None = None) -> int:
    """As `replace_partitions`; partitions in ``touched`` without rows any more are dropped.

    Rows and the touched partitions are written down before the catalog changes, so a
    repeated call goes on from there whatever the table looks like by then.
    """
    spark = df.sparkSession
    names = partition_columns(df, table)
    if not names:
        raise ValueError(f"{table} has no partitions")
    kind = described(spark, table)["Provider"]
    rows_at, left_at = f"{location}/{_ROWS}", f"{location}/{_LEFT}"
    schema = spark.table(table).schema
    if exists(spark, f"{left_at}/_SUCCESS"):
        rows = spark.read.format(kind).schema(schema).load(rows_at).count()
    else:
        rows = write_counted(
            clustered(df, names),
            lambda out: out.write.format(kind)
            .mode("overwrite")
            .partitionBy(*names)
            .save(rows_at),
        )
        left = touched if touched is not None else df.select(*names).limit(0)
        left.distinct().write.mode("overwrite").parquet(left_at)
    written = directories(spark, rows_at, schema, names, kind)
    register(spark, table, names, written, replace=True)
    kept = {values for values, _ in written}
    # As many rows as partitions, which is what the catalog is told one by one.
    for row in spark.read.parquet(left_at).collect():
        if tuple(row) not in kept:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {_spec(names, tuple(row))}")
    spark.catalog.refreshTable(table)
    return rows


def directories(
    spark: SparkSession, path: str, schema: StructType, names: Sequence[str], kind: str
) -> list[tuple[tuple, str]]:
    """The partitions written below a path, each with its directory; no data is read."""
    files = spark.read.format(kind).schema(schema).load(path)
    folder = F.regexp_extract("_metadata.file_path", "^(.*)/[^/]*$", 1)
    found = files.select(*names, folder.alias("__folder")).distinct().collect()
    return [(tuple(row)[:-1], unquote(row["__folder"])) for row in found]


def register(
    spark: SparkSession,
    table: str,
    names: Sequence[str],
    found: list[tuple[tuple, str]],
    replace: bool = False,
) -> None:
    """Add partitions at their directories; with ``replace`` those that are there move.

    New ones are added in one statement.
    """
    if not found:
        return
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{MOVED}' = 'true')")
    added = " ".join(f"{_spec(names, values)} LOCATION {quoted(at)}" for values, at in found)
    spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {added}")
    if replace:
        for values, at in found:
            spark.sql(f"ALTER TABLE {table} {_spec(names, values)} SET LOCATION {quoted(at)}")


def moved(spark: SparkSession, table: str) -> bool:
    """Whether partitions of the table may lie outside of its folder."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").collect()
    return any(row["key"] == MOVED and row["value"] == "true" for row in rows)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, on whatever file system Spark knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def _spec(names: Sequence[str], values: tuple) -> str:
    pairs = (
        f"`{name}` = {'null' if value is None else quoted(str(value))}"
        for name, value in zip(names, values, strict=True)
    )
    return f"PARTITION ({', '.join(pairs)})"
