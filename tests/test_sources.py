from __future__ import annotations

import datetime

import pytest
from pyspark.errors import AnalysisException

from conform.sources import (
    empty_frame,
    read_delimited,
    read_delimited_checked,
    read_table,
    read_table_or_empty,
    rows_frame,
    run_sql,
    table_exists,
)
from tests.data import parcels, ships, tuples

SCHEMA = "`a b` int, c string"


@pytest.fixture
def shards(tmp_path):
    (tmp_path / "ods_1.csv").write_bytes("a b|c\r\n1|x\r\nnull|Bogotá\r\n".encode())
    (tmp_path / "ods_2.csv").write_bytes("a b|c\r\n2|null\r\n".encode())
    return tmp_path


def test_glob_with_null_token_and_crlf(spark, shards):
    df = read_delimited(spark, f"{shards}/ods_*.csv", "|", SCHEMA)
    assert tuples(df) == [(None, "Bogotá"), (1, "x"), (2, None)]


def test_some_columns_or_none(spark, shards):
    df = read_delimited(spark, f"{shards}/ods_*.csv", "|", SCHEMA)
    assert tuples(df.select("c")) == [(None,), ("Bogotá",), ("x",)]
    assert df.count() == 3


def test_inferred_types_equal_the_given_schema(spark, shards):
    df = read_delimited(spark, f"{shards}/ods_*.csv", "|", infer=True)
    assert df.dtypes == [("a b", "int"), ("c", "string")]
    assert tuples(df) == [(None, "Bogotá"), (1, "x"), (2, None)]


def test_without_a_schema_all_is_text(spark, shards):
    df = read_delimited(spark, f"{shards}/ods_*.csv", "|")
    assert df.dtypes == [("a b", "string"), ("c", "string")]


@pytest.mark.parametrize("how", [{"schema": SCHEMA}, {"infer": True}])
def test_a_file_with_swapped_headers_fails(spark, shards, how):
    (shards / "ods_3.csv").write_text("c|a b\ny|3\n")
    with pytest.raises(Exception, match="header does not conform"):
        read_delimited(spark, f"{shards}/ods_*.csv", "|", **how).collect()


def test_schema_and_inference_exclude_each_other(spark, shards):
    with pytest.raises(ValueError):
        read_delimited(spark, str(shards), "|", SCHEMA, infer=True)


def test_nested_rows(spark):
    df = ships(spark)
    assert df.select("ship.hull", "crew").first() == ("K-12", 18)
    assert df.dtypes[0] == ("ship", "struct<maker:string,series:string,hull:string>")


def test_rows_have_a_known_size(spark, capsys):
    df = spark.range(10**6).join(rows_frame(spark, [(1, "a")], "id bigint, x string"), "id")
    df.explain()
    assert "BroadcastHashJoin" in capsys.readouterr().out


def test_rows_of_a_wrong_width_are_refused(spark):
    with pytest.raises(ValueError):
        rows_frame(spark, [(1,)], "a int, b int")


def test_rows_with_times_and_nulls(spark):
    when = datetime.datetime(2020, 2, 29, 5, 6, tzinfo=datetime.timezone.utc)
    df = rows_frame(
        spark, [(when, when.date(), True), (None, None, None)], "t timestamp, d date, b boolean"
    )
    assert df.first() == (when.replace(tzinfo=None), when.date(), True)
    assert df.count() == 2


def test_an_empty_frame_keeps_its_columns(spark):
    df = empty_frame(spark, "hashvalue string, n int")
    assert df.dtypes == [("hashvalue", "string"), ("n", "int")]
    assert df.where("hashvalue is not null").count() == 0
    assert rows_frame(spark, [], "a int").columns == ["a"]


def test_catalog_tables(spark, tmp_path):
    parcels(spark).write.option("path", str(tmp_path / "t")).saveAsTable("source_parcels")
    assert table_exists(spark, "source_parcels")
    assert read_table(spark, "source_parcels").count() == 7
    assert read_table(spark, "source_parcels", "price > 500").count() == 2
    assert read_table_or_empty(spark, "source_parcels", "x int").count() == 7
    spark.sql("drop table source_parcels")
    assert not table_exists(spark, "source_parcels")
    assert read_table_or_empty(spark, "source_parcels", "x int").columns == ["x"]
    with pytest.raises(AnalysisException):
        read_table(spark, "source_parcels")


def test_sql_over_named_frames(spark):
    df = run_sql(spark, "select item from {sent} where price > {least}".replace(
        "{least}", "500"), sent=parcels(spark))
    assert tuples(df) == [("desk",), ("rug",)]


def test_rejected_rows_do_not_depend_on_the_columns_used(spark, tmp_path):
    (tmp_path / "a.csv").write_text("k;n;t\n1;10;x\n2;ten;y\n3;30\n4;40;z;more\n5;null;w\n")
    good, bad = read_delimited_checked(spark, str(tmp_path), ";", "k int, n int, t string")
    assert good.columns == ["k", "n", "t"]
    assert sorted(row["k"] for row in good.select("k").collect()) == [1, 5]
    assert good.count() == 2 and bad.count() == 3
    assert {row["rejected_record"] for row in bad.collect()} == {"2;ten;y", "3;30", "4;40;z;more"}


def test_reader_options_are_passed_on(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("k;t\n1;'a;\u00fc'\n".encode("latin-1"))
    df = read_delimited(spark, str(tmp_path), ";", encoding="ISO-8859-1", quote="'")
    assert df.collect() == [("1", "a;\u00fc")]
