"""Casts that give null instead of an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DatetimeType,
    DataType,
    DecimalType,
    FractionalType,
    IntegralType,
    StringType,
)

_WHOLE = r"^\s*[+-]?\d+\s*$"
_WITH_FRACTION = r"^\s*[+-]?\d+(\.\d*)?\s*$"
_FRACTION_ONLY = r"^\s*[+-]?\.\d*\s*$"
_MAY_BE_NUMBER = r"\p{Nd}|(?i:inf|nan)"
_HAS_DIGIT = r"\d"


def safe_cast(
    column: Column,
    source: DataType,
    target: DataType | str,
    truncate: bool = False,
) -> Column:
    """Cast a column of type ``source``; null where the value does not fit.

    ``truncate`` matters for text to a whole number: text with a fraction then
    loses the fraction ('1.5' to 1, '-2.9' to -2), as in Spark outside ANSI
    mode. Without it such text gives null.
    """
    if isinstance(target, str):
        target = DataType.fromDDL(target)
    if not isinstance(source, StringType):
        return column.try_cast(target)
    return _text_to(column, target, truncate).try_cast(target)


def _text_to(column: Column, target: DataType, truncate: bool) -> Column:
    # ``try_cast`` raises and catches an error for each text it cannot read,
    # which takes ten times as long as sorting most of them out beforehand.
    if isinstance(target, IntegralType):
        if not truncate:
            return F.when(column.rlike(_WHOLE), column)
        return F.when(
            column.rlike(_WITH_FRACTION), F.substring_index(column, ".", 1)
        ).when(column.rlike(_FRACTION_ONLY), F.lit("0"))
    if isinstance(target, FractionalType | DecimalType):
        return F.when(column.rlike(_MAY_BE_NUMBER), column)
    if isinstance(target, DatetimeType):
        return F.when(column.rlike(_HAS_DIGIT), column)
    return column
