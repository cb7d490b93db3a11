from __future__ import annotations

import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from conform.functions import safe_cast
from conform.operators import cast_checked, cast_counts, cast_lost_rows
from conform.sources import rows_frame

# text, as a whole number, the same with the fraction cut off
EDGES = [
    ("3000", 3000, 3000),
    ("abc", None, None),
    (None, None, None),
    ("1.5", None, 1),
    (" 7 ", 7, 7),
    ("1e3", None, None),
    ("-2.9", None, -2),
    (".5", None, 0),
    ("+4", 4, 4),
    ("", None, None),
    ("1.2.3", None, None),
    ("99999999999", None, None),
]


@pytest.fixture(scope="module")
def edges(spark):
    return rows_frame(spark, [(edge[0],) for edge in EDGES], "x string")


def test_edges(edges):
    strict = safe_cast(F.col("x"), StringType(), "int")
    cut = safe_cast(F.col("x"), StringType(), "int", truncate=True)
    assert [tuple(row) for row in edges.select("x", strict, cut).collect()] == EDGES


@pytest.mark.parametrize("target", ["int", "bigint", "smallint"])
def test_truncating_equals_the_cast_outside_ansi_mode(spark, target):
    picks = random.Random(7)
    texts = {"".join(picks.choices("0123459.-+ eE", k=picks.randint(0, 6))) for _ in range(3000)}
    df = rows_frame(spark, [(text,) for text in sorted(texts)], "x string")
    ours = df.select(safe_cast(F.col("x"), StringType(), target, truncate=True)).collect()
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        theirs = df.select(F.col("x").cast(target)).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    different = [
        (text, a[0], b[0]) for text, a, b in zip(sorted(texts), ours, theirs) if a[0] != b[0]
    ]
    assert different == []


@pytest.mark.parametrize("target", ["int", "double", "decimal(10,2)", "date", "timestamp", "float"])
def test_the_strict_cast_equals_try_cast(spark, target):
    picks = random.Random(8)
    texts = {"".join(picks.choices("0129.-+ eEdfNaNInfinty:/T", k=picks.randint(0, 8)))
             for _ in range(2000)}
    texts |= {"NaN", "inf", "-Infinity", "1d", "2020-02-29", "2020-2", "2020", "12:30", "now",
              "epoch", "2020-01-01T10:00:00Z", "1e5", "٣", "７"}
    df = rows_frame(spark, [(text,) for text in sorted(texts)], "x string")
    ours = safe_cast(F.col("x"), StringType(), target)
    theirs = F.col("x").try_cast(target)
    assert df.where(~ours.eqNullSafe(theirs)).collect() == []


def test_other_types_are_cast_as_they_are(spark):
    df = rows_frame(spark, [(2.9,), (1e30,)], "x double")
    cast = safe_cast(F.col("x"), df.schema["x"].dataType, "int")
    assert [row[0] for row in df.select(cast).collect()] == [2, None]


def test_checked_cast_reports_what_it_loses(edges):
    assert [row[0] for row in cast_checked(edges, "x", "int").collect()] == [
        edge[1] for edge in EDGES
    ]
    lost = [edge[0] for edge in EDGES if edge[0] is not None and edge[1] is None]
    assert [row[0] for row in cast_lost_rows(edges, "x", "int").collect()] == lost


def test_every_value_is_kept_changed_or_lost(edges):
    for truncate in (False, True):
        counts = cast_counts(edges, "x", "int", truncate).first()
        assert sum(counts) == len(EDGES)
    assert cast_counts(edges, "x", "int").first() == (2, 2, 8)  # ' 7 ' and '+4' change
    assert cast_counts(edges, "x", "int", True).first() == (2, 5, 5)


def test_a_cast_that_does_not_exist_gives_nulls(spark):
    df = rows_frame(spark, [(["a"], 1), (None, 2)], "x array<string>, n int")
    assert cast_checked(df, "x", "int").collect() == [(None, 1), (None, 2)]
    assert cast_checked(df, "x", "int").dtypes[0] == ("x", "int")
    assert cast_lost_rows(df, "x", "int").count() == 1
    assert cast_counts(df, "x", "int").first() == (1, 0, 1)


def test_an_unknown_column_is_an_error(spark):
    df = rows_frame(spark, [("1",)], "a string")
    with pytest.raises(AnalysisException):
        cast_checked(df, "b", "int")
    assert cast_checked(df, "A", "int").collect() == [(1,)]
