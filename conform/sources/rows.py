"""Rows held in the program: rule lists, dictionaries, audit records."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def rows_frame(
    spark: SparkSession, rows: Iterable[Sequence[Any]], schema: StructType | str
) -> DataFrame:
    """Make a DataFrame of tuples, nested tuples standing for structs.

    The rows go through Arrow, so Spark knows their size and can broadcast
    them in a join by its own threshold; a list given straight to
    ``createDataFrame`` has no size estimate and would be shuffled.
    """
    schema = _as_schema(schema)
    records = [_as_record(row, schema) for row in rows]
    if not records:
        return empty_frame(spark, schema)
    return spark.createDataFrame(pa.Table.from_pylist(records), schema=schema)


def empty_frame(spark: SparkSession, schema: StructType | str) -> DataFrame:
    """Make a DataFrame without rows that still has its columns."""
    schema = _as_schema(schema)
    columns = [pa.nulls(0)] * len(schema.fields)
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema.names), schema=schema)


def _as_schema(schema: StructType | str) -> StructType:
    return StructType.fromDDL(schema) if isinstance(schema, str) else schema


def _as_record(row: Sequence[Any], schema: StructType) -> dict[str, Any]:
    if len(row) != len(schema.fields):
        raise ValueError(f"row has {len(row)} values for {len(schema.fields)} columns")
    return {
        field.name: _as_record(value, field.dataType)
        if isinstance(field.dataType, StructType) and value is not None
        else value
        for field, value in zip(schema.fields, row)
    }
