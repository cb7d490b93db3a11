"""Compare schemas, read control tables, and cast with a check for loss."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, StructType

from conform.functions import safe_cast


def column_names(df: DataFrame) -> list[str]:
    return [field.name.lower() for field in df.schema]


def column_names_types(df: DataFrame) -> list[str]:
    """``name-!-type`` of each column."""
    return [f"{field.name.lower()}-!-{_type_name(field.dataType)}" for field in df.schema]


def not_null_columns(df: DataFrame) -> list[str]:
    return [field.name.lower() for field in df.schema if not field.nullable]


def difference_columns(names: Sequence[str], others: Sequence[str]) -> list[str]:
    """The names that are not among the others, in their order."""
    known = set(others)
    return [name for name in names if name not in known]


def common_columns(names: Sequence[str], others: Sequence[str]) -> list[str]:
    """The names that are among the others, in their order."""
    known = set(others)
    return [name for name in names if name in known]


def column_report(names: Sequence[str]) -> str:
    """The names as lines of a list."""
    return "".join(f"\n- {name}" for name in names)


def same_schema(left: StructType, right: StructType, strict: bool = True) -> bool:
    """Whether names, order and types agree, and with ``strict`` nullability."""
    if strict:
        return left == right
    return [(f.name, f.dataType) for f in left] == [(f.name, f.dataType) for f in right]


def control_columns(control: DataFrame, among: Sequence[str] | None = None) -> list[str]:
    """The columns to work on, from the third column of a control table.

    With ``among``, the columns of the frame to work on, Spark splits the lists and keeps
    the names that are among them, each once and in their order: the driver gets no more
    names than the frame has, however long the table is. Without, all rows are collected.
    """
    listed = control.select(F.col(f"`{control.columns[2]}`").alias("names"))
    if among is None:
        return [n for row in listed.collect() for n in (row["names"] or "").split(",") if n]
    if not among:
        return []
    names = listed.select(F.explode(F.split("names", ",")).alias("name"))
    found = {row[0] for row in names.select(_known("name", among)).distinct().collect()}
    return [name for name in among if name in found]


def control_pairs(
    control: DataFrame, among: Sequence[str] | None = None
) -> list[list[str]]:
    """The pairs of columns to protect together: second and third column.

    With ``among``, the columns of the frame to work on, only pairs of them, each once:
    the driver gets no more pairs than the frame has.
    """
    one, two = (F.col(f"`{name}`") for name in control.columns[1:3])
    if among is None:
        return [list(row) for row in control.select(one, two).collect()]
    if not among:
        return []
    pairs = control.select(
        _known(one, among).alias("one"), _known(two, among).alias("two")
    ).dropna()
    found = {tuple(row) for row in pairs.distinct().collect()}
    return [[a, b] for a in among for b in among if (a, b) in found]


def _known(name: Column | str, among: Sequence[str]) -> Column:
    """The frame's spelling of a name, in whatever case it is given; null for others."""
    spelled = F.create_map(*(F.lit(x) for n in among for x in (n.lower(), n)))
    return F.try_element_at(spelled, F.lower(F.trim(name)))


def cast_checked(
    df: DataFrame, column: str, data_type: DataType | str, truncate: bool = False
) -> DataFrame:
    """Cast a column in place; what does not fit becomes null.

    Where no value of the column's type can be cast at all, the whole column
    becomes null. `cast_lost_rows` and `cast_counts` tell what was lost.
    """
    return df.withColumn(column, cast_or_null(df, column, data_type, truncate))


def cast_lost_rows(
    df: DataFrame, column: str, data_type: DataType | str, truncate: bool = False
) -> DataFrame:
    """The rows whose value is not null, but is after the cast."""
    cast = cast_or_null(df, column, data_type, truncate)
    return df.where(F.col(f"`{column}`").isNotNull() & cast.isNull())


def cast_counts(
    df: DataFrame, column: str, data_type: DataType | str, truncate: bool = False
) -> DataFrame:
    """One row: how many values a cast keeps, changes and loses.

    A value is changed if its text is another after the cast. Nulls are kept.
    """
    cast = cast_or_null(df, column, data_type, truncate)
    both = df.select(F.col(f"`{column}`").alias("value"), cast.alias("cast"))
    lost = F.col("value").isNotNull() & F.col("cast").isNull()
    changed = F.col("cast").cast("string") != F.col("value").cast("string")
    return both.agg(
        F.count_if(~lost & ~F.coalesce(changed, F.lit(False))).alias("kept"),
        F.count_if(changed).alias("changed"),
        F.count_if(lost).alias("lost"),
    )


def cast_or_null(
    df: DataFrame, column: str, data_type: DataType | str, truncate: bool = False
) -> Column:
    """The cast of a column, or nulls where Spark has no such cast."""
    value = F.col(f"`{column}`")
    cast = safe_cast(value, df.select(value).schema[0].dataType, data_type, truncate)
    try:
        df.select(cast).schema  # noqa: B018 - asks Spark whether the cast exists
    except AnalysisException:
        return F.lit(None).cast(data_type)
    return cast


def _type_name(data_type: DataType) -> str:
    return (
        data_type.simpleString()
        if isinstance(data_type, DecimalType)
        else data_type.typeName()
    )
