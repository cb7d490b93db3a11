"""The table of keys already seen."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.operators.protect import CIPHER, HASH, VAULT_SCHEMA
from conform.sinks.counting import write_counted
from conform.sinks.partitions import quoted
from conform.sinks.tables import described
from conform.sources import empty_frame


def create_vault(spark: SparkSession, table: str, location: str, buckets: int) -> None:
    """Create an empty vault, bucketed by the hash.

    Every load looks all its keys up in the vault. Bucketed, the vault is not
    shuffled for that, only the keys of the load are. Choose ``buckets`` like
    ``spark.sql.shuffle.partitions``, for the size the vault will grow to.
    """
    empty_frame(spark, VAULT_SCHEMA).write.format("parquet").option("path", location).bucketBy(
        buckets, HASH
    ).sortBy(HASH).saveAsTable(table)


def compact_vault(spark: SparkSession, table: str, location: str) -> int:
    """Write a bucketed vault anew to ``location``, each hash once, and point the table there.

    Loads leave small files in every bucket, and two writers may have added a hash at
    the same time; of its ciphers, which stand for the same key, the least one stays.
    Buckets and their order are kept: rows of a bucket are read, folded and written by
    one task, so nothing of the vault is shuffled. The old files stay where they are.
    Meant for a time without writers. Returns the rows written.
    """
    about = described(spark, table)
    buckets = int(about.get("Num Buckets", 0))
    if not buckets:
        raise ValueError(f"{table} has no buckets")
    folded = spark.table(table).groupBy(HASH).agg(F.min(CIPHER).alias(CIPHER))
    copy = f"{table}_{uuid.uuid4().hex}"

    def write(out: DataFrame) -> None:
        writer = out.write.format(about["Provider"]).option("path", location)
        writer.bucketBy(buckets, HASH).sortBy(HASH).saveAsTable(copy)

    try:
        rows = write_counted(folded, write)
        # One step of the catalog: readers see the old files or the new ones.
        spark.sql(f"ALTER TABLE {table} SET LOCATION {quoted(location)}")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {copy}")  # external, its files stay
    spark.catalog.refreshTable(table)
    return rows
