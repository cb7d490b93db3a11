"""Projections: headers, derived columns, structs, split text, batch functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import TypeVar

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

from conform.functions import concat_key, hash_key, split_pieces

Setup = TypeVar("Setup")


def clean_headers(df: DataFrame) -> DataFrame:
    """Put ``_`` for every blank in the column names, in one projection."""
    names = [name.replace(" ", "_") for name in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"cleaned headers are not unique: {names}")
    return df.toDF(*names)


def add_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column, or replace the one of that name in its place."""
    return df.withColumn(name, value)


def null_column(df: DataFrame, name: str, data_type: DataType | str) -> DataFrame:
    """Replace a column by nulls of a type."""
    return df.withColumn(name, F.lit(None).cast(data_type))


def flatten_struct(df: DataFrame, name: str) -> DataFrame:
    """Put a struct's fields in the place of the struct."""
    columns = [f"`{other}`.*" if other == name else f"`{other}`" for other in df.columns]
    return df.select(*columns)


def split_to_columns(
    df: DataFrame, column: str, names: Sequence[str], sep: str = ","
) -> DataFrame:
    """Replace a text column by its pieces, at the end, under ``names``."""
    pieces = split_pieces(F.col(column), len(names), sep)
    return df.withColumns(dict(zip(names, pieces))).drop(
        *([] if column in names else [column])
    )


def combine_columns(
    df: DataFrame, columns: Sequence[str], name: str, sep: str = ","
) -> DataFrame:
    """Join columns' text into one column and drop them; a null part gives null."""
    return df.withColumn(name, concat_key(columns, sep)).drop(
        *(column for column in columns if column != name)
    )


def hash_and_drop(
    df: DataFrame,
    columns: Sequence[str],
    name: str,
    drop: Sequence[str] | None = None,
    sep: str = "",
) -> DataFrame:
    """Add the SHA-256 of ``columns`` and drop the plain columns.

    ``drop`` names the columns to leave out instead of just the hashed ones.
    """
    return df.withColumn(name, hash_key(columns, sep)).drop(
        *(columns if drop is None else drop)
    )


def project_like(df: DataFrame, other: DataFrame) -> DataFrame:
    """Select the columns of ``other``, in its order."""
    return df.select(*(f"`{name}`" for name in other.columns))


def map_batches(
    df: DataFrame,
    function: Callable[[pd.DataFrame, Setup], pd.DataFrame],
    schema: StructType | str,
    setup: Callable[[], Setup] = lambda: None,
) -> DataFrame:
    """Apply a pandas function to batches of rows.

    For work no Spark expression can do: rows leave the JVM through Arrow.
    ``setup`` runs once per task and its result goes to every call. Select only
    the columns the function needs beforehand.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        prepared = setup()
        for batch in batches:
            yield function(batch, prepared)

    return df.mapInPandas(run, schema)


def map_arrow(
    df: DataFrame,
    function: Callable[[pa.RecordBatch, Setup], pa.RecordBatch],
    schema: StructType | str,
    setup: Callable[[], Setup] = lambda: None,
) -> DataFrame:
    """Apply a function to Arrow batches, without pandas between.

    For work no Spark expression can do, on columns that pandas would turn into objects.
    ``setup`` runs once per task, before its first batch, and its result goes to every
    call; a task without rows does not run it. Select only the columns the function
    needs beforehand.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prepared, ready = None, False
        for batch in batches:
            if not ready:
                prepared, ready = setup(), True
            yield function(batch, prepared)

    return df.mapInArrow(run, schema)
