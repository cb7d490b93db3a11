"""Expressions that derive values."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def value_map(column: Column, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Replace the mapped values; all others become ``default`` (null if none)."""
    if not mapping:
        return F.lit(default)
    (first, replacement), *others = mapping.items()
    branches = F.when(column == F.lit(first), F.lit(replacement))
    for value, replacement in others:
        branches = branches.when(column == F.lit(value), F.lit(replacement))
    return branches.otherwise(F.lit(default))


def concat_key(columns: Sequence[Column | str], sep: str = "") -> Column:
    """Join the columns' text into one key; a null part makes the key null.

    Without a separator ('1', '23') and ('12', '3') give the same key. That is
    the compatible form; pass ``sep`` where keys must stay apart.
    """
    parts: list[Column] = []
    for position, name in enumerate(columns):
        if position and sep:
            parts.append(F.lit(sep))
        parts.append((F.col(name) if isinstance(name, str) else name).cast("string"))
    return F.concat(*parts)


def split_pieces(column: Column, count: int, sep: str = ",") -> list[Column]:
    """Split text and give its first ``count`` pieces, null where there are fewer.

    Pieces keep their blanks.
    """
    pieces = F.split(column, re.escape(sep))
    return [F.get(pieces, F.lit(index)) for index in range(count)]
