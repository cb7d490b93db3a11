from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conform.functions import concat_key, split_pieces, value_map
from conform.operators import (
    add_column,
    clean_headers,
    combine_columns,
    flatten_struct,
    hash_and_drop,
    map_batches,
    null_column,
    project_like,
    split_to_columns,
)
from conform.sources import rows_frame
from tests.data import plan_of, routes, ships, tuples


def test_clean_headers(spark):
    df = rows_frame(spark, [(1, 2)], "`NOMBRE DEL CLIENTE` int, ID int")
    assert clean_headers(df).columns == ["NOMBRE_DEL_CLIENTE", "ID"]


def test_clean_headers_refuses_equal_names(spark):
    with pytest.raises(ValueError):
        clean_headers(rows_frame(spark, [(1, 2)], "`a b` int, a_b int"))


def test_value_map_with_and_without_default(spark):
    df = rows_frame(spark, [(1,), (0,), (7,), (None,)], "estado int")
    texts = {1: "Activo", 0: "Inactivo"}
    with_default = df.select("estado", value_map(F.col("estado"), texts, "Unknown"))
    assert tuples(with_default) == [
        (None, "Unknown"), (0, "Inactivo"), (1, "Activo"), (7, "Unknown")
    ]
    without = df.select("estado", value_map(F.col("estado"), texts))
    assert tuples(without) == [(None, None), (0, "Inactivo"), (1, "Activo"), (7, None)]
    assert df.select(value_map(F.col("estado"), {}, "x")).distinct().collect() == [("x",)]


def test_add_replace_and_null_columns(spark):
    df = ships(spark).select("number", "crew")
    assert add_column(df, "twice", F.col("crew") * 2).first() == ("PX-204", 18, 36)
    assert add_column(df, "crew", F.col("crew") * 100).first() == ("PX-204", 1800)
    nulled = null_column(df, "number", "date")
    assert nulled.dtypes == [("number", "date"), ("crew", "int")]
    assert nulled.first() == (None, 18)


def test_structs(spark):
    flat = flatten_struct(ships(spark), "ship")
    assert flat.columns == ["maker", "series", "hull", "number", "kind", "crew"]
    assert flat.first()[:3] == ("Norda ", "", "K-12")


def test_filters_on_arrays_and_structs(spark):
    df = routes(spark)
    assert df.filter(df.sea == "north").count() == 2
    assert df.filter("kind == 'cargo'").count() == 3
    assert df.filter((df.sea == "east") & (df.kind == "cargo")).count() == 2
    assert df.filter(F.array_contains("ports", "Riga")).count() == 2
    assert df.filter(F.col("ship.maker") == "Velu").count() == 2


def test_split_keeps_blanks_and_gives_null_beyond_the_end(spark):
    df = rows_frame(
        spark,
        [("Tinte; blau", "Regal 4; Fach b; links; 17"), ("Papier; rau", "Regal 11")],
        "ware string, lager string",
    )
    names = split_to_columns(df, "ware", ["was", "wie"], ";")
    assert names.columns == ["lager", "was", "wie"]
    assert names.first() == ("Regal 4; Fach b; links; 17", "Tinte", " blau")
    pieces = df.select(*split_pieces(F.col("lager"), 4, ";"))
    assert pieces.collect() == [
        ("Regal 4", " Fach b", " links", " 17"), ("Regal 11", None, None, None)
    ]
    assert df.select(*split_pieces(F.lit("a.b|c"), 2, ".")).first() == ("a", "b|c")
    assert split_to_columns(df, "ware", ["ware", "wie"], ";").first()[0] == "Tinte"


def test_concat_key(spark):
    df = rows_frame(spark, [("1", 23), ("12", 3), (None, 4)], "a string, b int")
    assert [r[0] for r in df.select(concat_key(["a", "b"])).collect()] == ["123", "123", None]
    assert [r[0] for r in df.select(concat_key(["a", "b"], "|")).collect()] == [
        "1|23", "12|3", None
    ]


def test_combine_columns(spark):
    df = ships(spark).select("ship.*", "crew")
    combined = combine_columns(df, ["maker", "series", "hull"], "full")
    assert combined.columns == ["crew", "full"]
    assert combined.first() == (18, "Norda ,,K-12")


def test_hash_and_drop(spark):
    df = rows_frame(spark, [("CC", 83120457, "x")], "kind string, id int, rest string")
    hashed = hash_and_drop(df, ["kind", "id"], "SHA-256")
    assert hashed.columns == ["rest", "SHA-256"]
    assert hashed.first()[1] == (
        "a20011168dbc433f470293d6731e2ec607f717ba8aaaca2e019c309af4096bfe"
    )
    assert hash_and_drop(df, ["kind", "id"], "h", drop=["rest"]).columns == ["kind", "id", "h"]


def test_project_like(spark):
    df = rows_frame(spark, [(1, 2, 3)], "c int, a int, b int")
    other = rows_frame(spark, [(0, 0)], "a int, c int")
    assert project_like(df, other).collect() == [(2, 1)]


def test_map_batches_prepares_once_per_task(spark):
    def setup() -> list[int]:
        return []

    def number(batch: pd.DataFrame, seen: list[int]) -> pd.DataFrame:
        seen.append(len(batch))
        return batch.assign(batches=len(seen))

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10)
    try:
        df = map_batches(spark.range(0, 30, 1, 1), number, "id long, batches int", setup)
        counts = df.groupBy("batches").count()
        assert tuples(counts) == [(1, 10), (2, 10), (3, 10)]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_projections_collapse(spark, sf_dir, capsys):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for name in ("l_tax", "l_discount"):
        lines = add_column(lines, name, F.col(name) * 100)
    plan = plan_of(clean_headers(lines).select("l_tax"), capsys)
    assert "ReadSchema: struct<l_tax:double>" in plan
    assert plan.count("Project") == 2  # one node, named in the tree and in the details
