"""Exact duplicates found by a stream that keeps every digest it has seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.llm.tables import BLANKS, stored
from conform.queries.registry import scratch

DISK_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LOCATOR = ["_file", "_row"]
EMPTY_STATE = "_digest string, keep_id long, _keep_file string, _keep_row long, seen long"


def normalised(text: Column) -> Column:
    """Text with each run of blanks replaced by one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def digest_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(rows: DataFrame, digest=digest_of) -> DataFrame:
    """Identifier, normalised text, its digest, and where the content lies."""
    return rows.select(
        "doc_id",
        normalised(F.col("text")).alias("_text"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    ).withColumn("_digest", digest(F.col("_text")))


def seen_digests(
    spark: SparkSession, path: str, digest=digest_of, files_per_batch: int | None = None
) -> DataFrame:
    """What the stream over a folder of Parquet files knows of each digest when it has read all.

    The state is keyed by digest, lies on disk (RocksDB, copied to the shared folder
    with every batch) and never expires; it holds the smallest identifier, where that
    row's content lies, and how many rows came. Batches may come in any order.
    """
    # Only this session's streams keep their state on disk; the caller's stay as they are.
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", DISK_STORE)
    # Many small stores: no space set aside before it is needed.
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    # A task closes its store when it is done, so that an executor holds as many as it
    # has cores, and not its share of all partitions until the next clean-up.
    session.conf.set("spark.sql.streaming.stateStore.unloadOnCommit", "true")
    parts = "spark.sql.shuffle.partitions"
    session.conf.set(parts, spark.conf.get(parts))
    schema = spark.read.parquet(path).schema
    reader = session.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A pattern that fits only this path: without one, a stream takes folders only.
    rows = located(reader.parquet(f"{path[:-1]}[{path[-1]}]"), digest)
    state = rows.groupBy("_digest").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", *LOCATOR)).alias("first"),
        F.count("*").alias("seen"),
    )
    checkpoint = scratch(spark, "seen")
    stream = (
        state.writeStream.format("noop")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    if stream.lastProgress is None:  # no file, so no state either
        return spark.createDataFrame([], EMPTY_STATE)
    store = spark.read.format("statestore").load(checkpoint)
    first, seen = store.schema["value"].dataType.names
    return store.select(
        F.col("key._digest").alias("_digest"),
        F.col(f"value.{first}.doc_id").alias("keep_id"),
        F.col(f"value.{first}._file").alias("_keep_file"),
        F.col(f"value.{first}._row").alias("_keep_row"),
        F.col(f"value.{seen}").alias("seen"),
    )


def duplicates(
    spark: SparkSession, path: str, digest=digest_of, files_per_batch: int | None = None
) -> DataFrame:
    """One row for each document in a folder of Parquet files: which row stays in its stead.

    Texts are equal when they are the same bytes after blanks are collapsed. Columns:
    ``doc_id, keep_id, group_size, kept, _digest, _file, _row``. Of equal texts the
    smallest identifier stays; rows that repeat an identifier are told apart by where
    they lie, and the first of them stays; a null identifier stays only if no row
    with one has that text. Null and empty texts are equal. An empty folder gives no
    rows. Other columns are not read.

    A hit on a digest is believed only after its bytes are compared with those of the
    row that stays. Texts that differ in spite of equal digests form groups of their
    own by their bytes.
    """
    rows = located(spark.read.parquet(path), digest)
    state = stored(seen_digests(spark, path, digest, files_per_batch), "state")
    known = stored(
        rows.select("doc_id", "_digest", *LOCATOR).join(state, "_digest"), "known"
    ).withColumn(
        "_stays", (F.col("_file") == F.col("_keep_file")) & (F.col("_row") == F.col("_keep_row"))
    )
    hits = known.where("not _stays").select("doc_id", "_digest", *LOCATOR, "_keep_file", "_keep_row")
    texts = rows.select(*LOCATOR, "_text")
    kept_texts = texts.select(
        F.col("_file").alias("_keep_file"),
        F.col("_row").alias("_keep_row"),
        F.col("_text").alias("_keep_text"),
    )
    differing = stored(
        hits.join(texts, LOCATOR)
        .join(kept_texts, ["_keep_file", "_keep_row"])
        .where("_text <> _keep_text")
        .select("doc_id", "_digest", *LOCATOR, "_text"),
        "differing",
    )
    place = F.struct(F.col("doc_id").isNull().alias("_none"), "doc_id", *LOCATOR)
    groups = differing.groupBy("_digest", "_text").agg(
        F.min(place).alias("_first"), F.count("*").alias("_own_size")
    )
    moved = differing.join(groups, ["_digest", "_text"]).select(
        *LOCATOR,
        F.col("_first.doc_id").alias("_own_keep"),
        (F.struct(*LOCATOR) == F.struct("_first._file", "_first._row")).alias("_own_stays"),
        "_own_size",
    )
    less = differing.groupBy("_digest").agg(F.count("*").alias("_less"))
    result = known.join(moved, LOCATOR, "left").join(less, "_digest", "left")
    own = F.col("_own_size").isNotNull()
    return result.select(
        "doc_id",
        F.when(own, F.col("_own_keep")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(own, F.col("_own_size"))
        .otherwise(F.col("seen") - F.coalesce("_less", F.lit(0)))
        .alias("group_size"),
        F.when(own, F.col("_own_stays")).otherwise(F.col("_stays")).alias("kept"),
        "_digest",
        *LOCATOR,
    )


def document_duplicates(spark: SparkSession, path: str) -> DataFrame:
    """The digest columns of the query: every document, dropped ones too."""
    return duplicates(spark, path).select(
        "doc_id", "keep_id", "group_size", "kept", F.col("_digest").alias("text_sha256")
    )


def without_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns.

    A stream reads files, so the rows are written to the shared folder first.
    """
    spark = docs.sparkSession
    path = scratch(spark, "landed")
    docs.write.parquet(path)
    kept = duplicates(spark, path).where("kept").select(*LOCATOR)
    landed = spark.read.schema(docs.schema).parquet(path)
    landed = landed.withColumns(
        {"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")}
    )
    return landed.join(kept, LOCATOR, "left_semi").select(*docs.columns)
