"""Contiguous shards of nearly equal bytes, cut from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.tables import free_name, ordered


def balanced_shards(
    df: DataFrame, keys: list[str], size: str = "size", shards: int = 8
) -> DataFrame:
    """Rows with ``shard`` and their ``slot`` there, contiguous in the order of ``keys``.

    The sum of all sizes before a row comes from totals of Spark's ranges plus a
    running sum within one. The line of all bytes is cut at equal targets, and a row
    goes where its middle byte lies: a shard misses its target by one row's size at
    most, whatever the number of rows. Sizes must not be negative; where all are 0
    every row goes to shard 0. Rows with a null key come first, repeated rows lie
    side by side, an empty table gives an empty one. Columns of any name are kept; if
    one is named ``shard`` or ``slot``, the new one gets a ``_`` behind its name.
    """
    # Within, columns go by their places, so that no name meets those of the steps.
    inner = {name.lower(): f"_column_{i}" for i, name in enumerate(df.columns)}
    measured = inner[size.lower()]
    rows = df.toDF(*inner.values())
    rows = ordered(rows, [inner[key.lower()] for key in keys], measured)
    middle = (2 * F.col("before") + F.col(measured)) * F.lit(shards)
    cut = F.when(
        F.col("total") > 0,
        F.least(F.expr("_middle div (2 * total)"), F.lit(shards - 1)),
    ).otherwise(0)
    rows = rows.withColumn("_middle", middle).withColumn("shard", cut.cast("int"))
    first = rows.groupBy(F.col("shard").alias("_shard")).agg(F.min("place").alias("_first"))
    # One row for each shard.
    rows = rows.join(F.broadcast(first), F.col("shard") == F.col("_shard"))
    return rows.select(
        *(F.col(inner[name.lower()]).alias(name) for name in df.columns),
        F.col("shard").alias(free_name(df, "shard")),
        (F.col("place") - F.col("_first")).alias(free_name(df, "slot")),
    )


def document_shards(documents: DataFrame, shards: int = 8) -> DataFrame:
    """Documents' shards by the bytes of their texts; the digest columns of the query.

    A null text has no bytes; every row counts one byte more, so that empty texts
    are spread as well. Texts are only measured, never moved.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = documents.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    placed = balanced_shards(rows, ["doc_id", "text_crc32", "size"], "size", shards)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
