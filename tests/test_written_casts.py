"""Casts observed within their write, files by their headers, and frames kept for a while."""

from __future__ import annotations

import uuid

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conform.operators import (
    control_columns,
    control_pairs,
    map_arrow,
    rule_conflicts,
    standardise,
    vault_delta,
)
from conform.plans import AuditRun
from conform.sinks import CastCounts, compact_vault, create_vault, insert, write_casts
from conform.sources import (
    TooManyRejectedError,
    kept,
    read_delimited_by_header,
    read_delimited_checked,
    refuse_rejected,
    rows_frame,
)
from tests.data import tuples

VALUES = [("3000", "1"), ("abc", None), (None, "x"), ("1.5", "2"), (" 7 ", "y"), ("-2.9", "3")]


@pytest.fixture
def mixed(spark):
    rows = [(n, a, b) for n, (a, b) in enumerate(VALUES)]
    return rows_frame(spark, rows, "id int, `a.b` string, second string")


def test_a_cast_is_written_and_counted_by_one_job(spark, mixed, tmp_path):
    group = f"casts-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, "a write with casts")
    try:
        written = write_casts(mixed, {"a.b": "int", "second": "int"}, str(tmp_path / "out"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(group)) == 1
    assert written.counts == {"a.b": CastCounts(2, 1, 3), "second": CastCounts(4, 0, 2)}
    assert written.written == 6
    assert written.rows.columns == mixed.columns
    assert tuples(written.rows) == [
        (0, 3000, 1), (1, None, None), (2, None, None), (3, None, 2), (4, 7, None), (5, None, 3)
    ]
    lost = {row["id"]: [tuple(v) for v in row["lost_values"]] for row in written.lost.collect()}
    assert lost == {
        1: [("a.b", "abc")], 2: [("second", "x")], 3: [("a.b", "1.5")],
        4: [("second", "y")], 5: [("a.b", "-2.9")],
    }
    run = AuditRun(spark, "a", "b")
    run.casts(written)
    assert (run.status, run.rows_loaded) == ("WARN", 6)
    assert run.messages == ["a.b: 3 values lost in the cast", "second: 2 values lost in the cast"]


def test_truncated_impossible_and_harmless_casts(spark, mixed, tmp_path):
    written = write_casts(mixed, {"a.b": "int"}, str(tmp_path / "a"), truncate=True)
    assert written.counts["a.b"] == CastCounts(2, 3, 1)
    words = mixed.withColumn("second", F.split("second", ","))
    written = write_casts(words, {"second": "int", "id": "bigint"}, str(tmp_path / "b"))
    assert written.counts == {"second": CastCounts(1, 0, 5), "id": CastCounts(6, 0, 0)}
    assert written.rows.dtypes == [("id", "bigint"), ("a.b", "string"), ("second", "int")]
    none = write_casts(mixed.where("id > 9"), {"second": "int"}, str(tmp_path / "c"))
    assert none.written == 0 and none.rows.count() == 0 and none.lost.count() == 0


def test_files_with_different_headers(spark, tmp_path):
    texts = {
        "a": "id|name|size\n1|one|10\n2|null|20\n",
        "b": "\ufeffSIZE| name |id\n30|three|3\n",
        "c": "id|other\n4|x\n",
        "d": 'id|"na|me"\n5|y\n',
        "e": "",
        "f": "name|id|size\n",
    }
    for name, text in texts.items():
        (tmp_path / f"{name} %.csv").write_text(text)
    schema = "id int, name string, size long"
    found = read_delimited_by_header(spark, f"{tmp_path}/*.csv", "|", schema)
    assert found.dtypes == [("id", "int"), ("name", "string"), ("size", "bigint")]
    assert tuples(found) == [
        (1, "one", 10), (2, None, 20), (3, "three", 30), (4, None, None), (5, None, None)
    ]
    every = read_delimited_by_header(spark, f"{tmp_path}/*.csv")
    assert sorted(map(str.lower, every.columns)) == ["id", "name", "na|me", "other", "size"]
    assert every.count() == 5
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.csv").write_text("")
    assert read_delimited_by_header(spark, f"{tmp_path}/none", "|", schema).count() == 0


def test_rejected_lines_tell_their_file_and_stop_a_load(spark, tmp_path):
    for name, text in {"a": "id;n\n1;2\nx;3\n", "b": "id;n\n4;y\n5\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text)
    good, bad = read_delimited_checked(spark, f"{tmp_path}/*.csv", ";", "id int, n int")
    assert tuples(good) == [(1, 2)]
    found = bad.select("rejected_record", "rejected_file", "rejected_block").collect()
    assert sorted((r[0], r[1].rsplit("/", 1)[1], r[2]) for r in found) == [
        ("4;y", "b.csv", 0), ("5", "b.csv", 0), ("x;3", "a.csv", 0)
    ]
    assert refuse_rejected(bad, 3) == 3
    with pytest.raises(TooManyRejectedError, match="more than 2 lines"):
        refuse_rejected(bad, 2)


def test_a_kept_frame_is_let_go(spark):
    cache = spark._jsparkSession.sharedState().cacheManager()
    df = spark.range(100).withColumn("x", F.rand())
    with kept(df) as held:
        assert held.agg(F.sum("x")).first() == held.agg(F.sum("x")).first()
        assert not cache.isEmpty()
    assert cache.isEmpty()
    with pytest.raises(RuntimeError):
        with kept(df) as held:
            held.count()
            raise RuntimeError
    assert cache.isEmpty()


def test_control_tables_are_read_down_to_the_width_of_the_frame(spark, monkeypatch):
    rows = spark.range(1_000_000).select(
        F.lit("t").alias("x"),
        F.when(F.col("id") % 2 == 0, "Id").otherwise(F.concat(F.lit("c"), "id")).alias("y"),
        F.when(F.col("id") % 3 == 0, " CITY ,zip").when(F.col("id") % 3 == 1, "zip,,id")
        .alias("z"),
    )
    pairs = [("t", "id", "city"), ("t", None, "city")]
    one = rows_frame(spark, pairs, "x string, y string, z string")
    control = rows.unionByName(one)
    sizes, collect = [], type(control).collect
    monkeypatch.setattr(
        type(control), "collect", lambda df: (sizes.append(len(got := collect(df))), got)[1]
    )
    columns = ["id", "zip", "city", "name"]
    assert control_columns(control, columns) == ["id", "zip", "city"]
    assert control_pairs(control, columns) == [["id", "city"]]
    assert max(sizes) <= len(columns)
    assert control_columns(control, []) == [] and control_pairs(control, []) == []
    assert control_columns(one) == ["city", "city"]


RULES = [("A1", "a"), ("A2", "a"), ("A1", "a"), ("B1", "b"), ("B1", "b"), ("N", None), ("M", None)]


def test_values_with_several_codes(spark):
    rules = rows_frame(spark, RULES, "codigo_id string, homologacion string")
    df = rows_frame(spark, [(1, "a"), (2, "b"), (3, "c"), (4, None)], "id int, v string")
    assert tuples(rule_conflicts(rules)) == [("a", 2, "A1", "A2")]
    assert standardise(df, rules, "v").count() == 5
    assert tuples(standardise(df, rules, "v", conflicts="first")) == [(1, "A1"), (2, "B1")]
    assert tuples(standardise(df, rules, "v", "left", conflicts="report")) == [
        (1, None), (2, "B1"), (3, None), (4, None)
    ]
    with pytest.raises(Exception, match="several codes for a"):
        standardise(df, rules, "v", conflicts="refuse").collect()
    once = rules.where("codigo_id <> 'A2'")
    assert standardise(df, once, "v", conflicts="refuse").count() == 2
    with pytest.raises(ValueError, match="conflicts"):
        standardise(df, rules, "v", conflicts="none")


def test_a_vault_is_compacted_where_it_lies(spark, tmp_path, capsys):
    vault = f"vault_{uuid.uuid4().hex}"
    create_vault(spark, vault, str(tmp_path / "v"), 4)
    keys = spark.range(500).select(F.col("id").alias("id"))
    none = spark.table(vault).where("false")
    try:
        for part in (keys.where("id < 300"), keys.where("id >= 200")):
            insert(vault_delta(part, [["id"]], "0123456789abcdef", none), vault)
        assert spark.table(vault).count() == 600
        spark.sparkContext._jvm.java.lang.System.gc()
        capsys.readouterr()
        spark.table(vault).groupBy("hashvalue").agg(F.min("aesvalue")).explain()
        assert "Exchange" not in capsys.readouterr().out
        assert compact_vault(spark, vault, str(tmp_path / "new")) == 500
        assert spark.table(vault).count() == 500
        assert len(list((tmp_path / "new").glob("*.parquet"))) == 4
        assert spark.sql("show tables").where(f"tableName like '{vault}_%'").count() == 0
        # It is bucketed still: another load finds its keys there.
        delta = vault_delta(keys, [["id"]], "0123456789abcdef", spark.table(vault))
        assert delta.count() == 0
        delta.explain()
        assert "Bucketed: true" in capsys.readouterr().out
    finally:
        spark.sql(f"drop table if exists {vault}")


def test_arrow_batches_with_a_setup_for_each_task(spark):
    def setup() -> list[int]:
        return []

    def numbered(batch: pa.RecordBatch, seen: list[int]) -> pa.RecordBatch:
        seen.append(batch.num_rows)
        calls = pa.array([len(seen)] * batch.num_rows, pa.int32())
        return pa.RecordBatch.from_arrays([batch.column("id"), calls], names=["id", "calls"])

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(0, 100, 1, 4)
        found = map_arrow(df, numbered, "id bigint, calls int", setup)
        counts = found.groupBy("calls").count().orderBy("calls").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [tuple(row) for row in counts] == [(1, 40), (2, 40), (3, 20)]
