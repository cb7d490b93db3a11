"""Documents made ready for training: five stages, each on all that the one before kept.

``STAGES`` lists them; ``run`` applies them to ``documents``, writing each result as
Parquet to the shared folder and reading it back for the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from conform.llm.exact_dedup import without_duplicates
from conform.llm.ngram_join import without_similar
from conform.llm.packing import document_sequences
from conform.llm.secrets import without_secrets
from conform.llm.tables import stored
from conform.llm.toxicity import without_toxic
from conform.queries.registry import table

#: No SQL: the model, the spans and the packing are not for SQL to say.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the severity model does not reject."""
    return without_toxic(docs, table(spark, sf_dir, "labels"))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest identifier."""
    return without_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest identifier."""
    return without_similar(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with marks in place of secrets."""
    return without_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document's tokens lies in the sequences."""
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return document_sequences(docs, vocabulary, public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", toxicity),
    ("exact dedup", exact_duplicates),
    ("n-gram join", near_duplicates),
    ("secrets", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
