from __future__ import annotations

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from conform.operators import (
    column_names,
    column_names_types,
    column_report,
    common_columns,
    control_columns,
    control_pairs,
    difference_columns,
    not_null_columns,
    same_schema,
)
from conform.sources import rows_frame
from tests.data import routes


def test_names_and_types(spark):
    df = routes(spark).select(
        F.col("ship").alias("SHIP"),
        "ports",
        F.lit(1).alias("One"),
        F.lit(1.5).cast("decimal(10,2)").alias("d"),
        F.current_timestamp().alias("t"),
    )
    assert column_names(df) == ["ship", "ports", "one", "d", "t"]
    assert column_names_types(df) == [
        "ship-!-struct", "ports-!-array", "one-!-integer", "d-!-decimal(10,2)",
        "t-!-timestamp",
    ]
    assert not_null_columns(df) == ["one", "t"]


def test_difference_and_common_split_the_first_list():
    a, b = ["c", "a", "x", "a"], ["a", "b"]
    assert difference_columns(a, b) == ["c", "x"]
    assert common_columns(a, b) == ["a", "a"]
    assert difference_columns(a, []) == a
    assert common_columns(a, []) == []


@given(st.lists(st.sampled_from("abcdef")), st.lists(st.sampled_from("abcdef")))
def test_the_two_lists_make_up_the_first(a, b):
    difference, common = difference_columns(a, b), common_columns(a, b)
    assert sorted(difference + common) == sorted(a)
    assert not set(difference) & set(b)
    assert set(common) <= set(b)
    assert [name for name in a if name in difference] == difference


def test_report():
    assert column_report(["a", "b"]) == "\n- a\n- b"
    assert column_report([]) == ""


def test_same_schema():
    one = StructType().add("a", IntegerType(), False)
    two = StructType().add("a", IntegerType(), True)
    other = StructType().add("b", IntegerType(), True)
    assert same_schema(one, one)
    assert not same_schema(one, two)
    assert same_schema(one, two, strict=False)
    assert not same_schema(two, other, strict=False)


def test_control_tables(spark):
    control = rows_frame(
        spark, [("1", "tipo", "id"), ("2", "nombre", "ciudad,pais")], "a string, b string, c string"
    )
    assert control_columns(control) == ["id", "ciudad", "pais"]
    assert control_pairs(control) == [["tipo", "id"], ["nombre", "ciudad,pais"]]
    assert control_columns(control.where("a = 'none'")) == []


def test_a_long_control_table(spark):
    control = spark.range(20_001).selectExpr("'t' a", "cast(id as string) b", "concat('c', id) c")
    assert sorted(control_columns(control)) == sorted(f"c{i}" for i in range(20_001))


