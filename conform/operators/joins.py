"""Equality joins that keep hot keys spread over tasks."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DatetimeType, NumericType, StringType

from conform.functions import safe_cast

# The join names accepted, and the join each of them means.
JOIN_KINDS = {
    "inner": "inner",
    "cross": "inner",
    "outer": "full",
    "full": "full",
    "fullouter": "full",
    "left": "left",
    "leftouter": "left",
    "right": "right",
    "rightouter": "right",
    "leftsemi": "semi",
    "semi": "semi",
    "leftanti": "anti",
    "anti": "anti",
}

_CAST = "__cast"
_COPY = "__copy"
_COPIES = 16


def equi_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "inner",
    hot: Collection[str] = ("left",),
    truncate: bool = False,
) -> DataFrame:
    """Join where each pair of columns is equal; all columns of both sides stay.

    Text is compared with a number or a date as one: text that is none matches
    nothing, nor does ``1.9`` match 1 unless ``truncate`` cuts fractions off, as
    casts outside ANSI mode do. ``cross`` with a condition is an inner join.

    ``hot`` names the sides on which single keys may hold a large share of the
    rows. At run time Spark splits such keys in an inner join on either side,
    in an outer join only on the side whose rows are all kept, and in a semi or
    anti join only on the left. Where it could not, an outer join is made of
    parts in which it can, a join and the rows without a partner, and a hot side
    that is only looked up is cut to its distinct keys. Sides are then read more
    than once, so they must give the same rows each time; ``hot=()`` reads each once.

    Broadcasts are left to Spark, which checks a side's size against its own
    threshold.
    """
    kind = JOIN_KINDS.get(how.lower().replace("_", ""))
    if kind is None:
        raise ValueError(f"unknown join {how!r}; use one of {', '.join(JOIN_KINDS)}")
    if unknown := set(hot) - {"left", "right"}:
        raise ValueError(f"hot names sides, not {sorted(unknown)}")

    if kind in ("semi", "anti"):
        return _lookup(left, right, on, kind, "left" in hot, "right" in hot, truncate)
    if kind == "inner" or not hot:
        return _join(left, right, on, kind, truncate)

    # One join keeps the rows of a side whose partners are not hot; what it
    # does not keep is added.
    keeps = {"left", "right"} if kind == "full" else {kind}
    if "left" in keeps and "right" not in hot:
        base = "left"
    elif "right" in keeps and "left" not in hot:
        base = "right"
    else:
        base = "inner"
    parts = [_join(left, right, on, base, truncate)]
    if "left" in keeps and base != "left":
        lone = _lookup(left, right, on, "anti", "left" in hot, "right" in hot, truncate)
        parts.append(lone.select(*_columns(lone), *_nulls(right)))
    if "right" in keeps and base != "right":
        turned = [(theirs, ours) for ours, theirs in on]
        lone = _lookup(right, left, turned, "anti", "right" in hot, "left" in hot, truncate)
        parts.append(lone.select(*_nulls(left), *_columns(lone)))
    return reduce(DataFrame.unionAll, parts)


def _join(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], how: str, truncate: bool
) -> DataFrame:
    # A cast is worked out once, as a column, and not in shuffle, sort and join.
    ours, theirs = _keyed(left, right, on, truncate, "l"), _keyed(
        right, left, [(b, a) for a, b in on], truncate, "r"
    )
    (left, names), (right, others) = ours, theirs
    conditions = [
        F.col(f"l.`{name}`") == F.col(f"r.`{other}`")
        for name, other in zip(names, others, strict=True)
    ]
    joined = left.alias("l").join(right.alias("r"), reduce(and_, conditions), how)
    return joined.drop(*(name for name in {*names, *others} if name.startswith(_CAST)))


def _keyed(
    df: DataFrame, other: DataFrame, on: Sequence[tuple[str, str]], truncate: bool, side: str
) -> tuple[DataFrame, list[str]]:
    """The frame with a column for each key that has to be cast, and the names of its keys."""
    names, plain = [], df
    for number, (name, partner) in enumerate(on):
        kind = plain.select(f"`{name}`").schema[0].dataType
        wanted = other.select(f"`{partner}`").schema[0].dataType
        if isinstance(kind, StringType) and isinstance(wanted, NumericType | DatetimeType):
            key = _key(plain, name, other, partner, truncate)
            name = f"{_CAST}_{side}{number}"
            df = df.withColumn(name, key)
        names.append(name)
    return df, names


def _key(
    df: DataFrame, name: str, other: DataFrame, partner: str, truncate: bool, side: str = ""
) -> Column:
    """A key column, as a number or date if it is text and its partner is one."""
    column = F.col(f"{side}`{name}`")
    kind = df.select(f"`{name}`").schema[0].dataType
    wanted = other.select(f"`{partner}`").schema[0].dataType
    if isinstance(kind, StringType) and isinstance(wanted, NumericType | DatetimeType):
        return safe_cast(column, kind, wanted, truncate)
    return column


def _lookup(
    df: DataFrame,
    other: DataFrame,
    on: Sequence[tuple[str, str]],
    kind: str,
    df_hot: bool,
    other_hot: bool,
    truncate: bool,
) -> DataFrame:
    """The rows of ``df`` that have (semi) or lack (anti) a partner."""
    names = [f"__key{number}" for number in range(len(on))]
    keys = other.select(
        *(
            _key(other, theirs, df, ours, truncate).alias(name)
            for name, (ours, theirs) in zip(names, on)
        )
    )
    if other_hot and not df_hot:
        keys = keys.distinct()
    elif other_hot:
        # Spark splits a hot key only where both sides come straight from a
        # shuffle by the keys. Plain distinct would have made that shuffle
        # already; with a few copies of each key left, it is made for the join.
        copy = F.spark_partition_id() % _COPIES
        keys = keys.withColumn(_COPY, copy).distinct().drop(_COPY)
    pairs = [(ours, name) for name, (ours, _) in zip(names, on)]
    return _join(df, keys, pairs, f"left_{kind}", truncate)


def _columns(df: DataFrame) -> list[Column]:
    return [F.col(f"`{name}`") for name in df.columns]


def _nulls(df: DataFrame) -> list[Column]:
    return [F.lit(None).cast(field.dataType).alias(field.name) for field in df.schema]
