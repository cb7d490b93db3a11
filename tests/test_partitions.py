"""Partitions that are replaced or entered through the catalog, and runs that are repeated."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from conform.sinks import (
    RUN,
    EmptyWriteError,
    SchemaMismatchError,
    partitions,
    published_runs,
    replace_partitions,
    runs,
    save,
    save_run,
    update_flag,
)
from conform.sources import rows_frame
from tests.data import tuples

SCHEMA = "id int, flag string, city string"
ROWS = [
    (1, "0", "Cali"), (2, "0", "N/A: 'x' 50%"), (3, "1", "Cali"), (4, "0", None), (5, None, "B")
]


@pytest.fixture
def df(spark):
    return rows_frame(spark, ROWS, SCHEMA)


@pytest.fixture
def table(spark):
    name = f"parts_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"drop table if exists {name}")


def shown(spark, table) -> set[str]:
    return {row[0] for row in spark.sql(f"show partitions {table}").collect()}


def ordered(rows) -> list[tuple]:
    return sorted(rows, key=lambda row: [(value is not None, str(value)) for value in row])


def test_replacing_partitions_through_the_catalog(spark, df, table, tmp_path):
    save(df, table, str(tmp_path / "t"), partitions=["city"])
    before = {p.name for p in (tmp_path / "t").rglob("*.parquet")}
    new = rows_frame(spark, [(9, "n", None), (8, "n", "Cali"), (7, "n", "neu/=")], SCHEMA)
    assert replace_partitions(new.select("city", "id", "flag"), table, str(tmp_path / "a b")) == 3
    kept = [row for row in ROWS if row[0] in (2, 5)]
    assert tuples(spark.table(table)) == ordered([*kept, *map(tuple, new.collect())])
    assert "city=neu%2F%3D" in shown(spark, table) and len(shown(spark, table)) == 5
    assert {p.name for p in (tmp_path / "t").rglob("*.parquet")} == before
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    # Made of the table itself, and rows that are appended later join what is there.
    grown = spark.table(table).where("city = 'Cali'").withColumn("flag", F.lit("own"))
    assert replace_partitions(grown, table, str(tmp_path / "b")) == 1
    save(rows_frame(spark, [(10, "more", "Cali")], SCHEMA), table, "", partitions=["city"])
    assert tuples(spark.table(table).where("city = 'Cali'")) == [
        (10, "more", "Cali"), (8, "own", "Cali")
    ]


def test_a_replacement_needs_columns_and_partitions(spark, df, table, tmp_path):
    save(df, table, str(tmp_path / "t"))
    with pytest.raises(ValueError, match="no partitions"):
        replace_partitions(df, table, str(tmp_path / "a"))
    with pytest.raises(SchemaMismatchError, match="flag"):
        replace_partitions(df.drop("flag"), table, str(tmp_path / "a"))


def test_rows_move_where_the_flag_is_a_partition(spark, df, table, tmp_path):
    save(df, table, str(tmp_path / "t"), partitions=["city", "flag"])
    still = {p.name for p in (tmp_path / "t" / "city=B").rglob("*.parquet")}
    # 1 leaves a partition empty and enters that of 3; 3 has the flag already.
    assert update_flag(spark, table, "id in (1, 3, 4)", str(tmp_path / "new")) == 3
    assert tuples(spark.table(table).select("id", "flag", "city")) == ordered(
        [(i, "1" if i in (1, 3, 4) else flag, city) for i, flag, city in ROWS]
    )
    assert "city=Cali/flag=0" not in shown(spark, table)
    assert "city=__HIVE_DEFAULT_PARTITION__/flag=0" not in shown(spark, table)
    assert len(shown(spark, table)) == 4
    assert {p.name for p in (tmp_path / "t" / "city=B").rglob("*.parquet")} == still
    assert update_flag(spark, table, "id = 99", str(tmp_path / "none")) == 0
    # A value of its own, and back.
    update_flag(spark, table, "id = 1", str(tmp_path / "x"), value="x")
    update_flag(spark, table, "id = 1", str(tmp_path / "y"), value="0")
    assert spark.table(table).where("id = 1").first()["flag"] == "0"
    assert spark.table(table).count() == 5 and "city=Cali/flag=x" not in shown(spark, table)
    with pytest.raises(ValueError, match="location"):
        update_flag(spark, table, "id = 1", "")


@pytest.mark.parametrize("step", ["register", "refresh"])
def test_a_move_that_failed_is_gone_on_with(spark, df, table, tmp_path, monkeypatch, step):
    save(df, table, str(tmp_path / "t"), partitions=["flag"])

    def broken(*_, **__):
        raise RuntimeError("the catalog is away")

    place = str(tmp_path / "new")
    with monkeypatch.context() as patch:
        if step == "register":
            patch.setattr(partitions, "register", broken)
        else:  # the new partitions are there, the empty ones were not dropped yet
            patch.setattr(partitions, "_spec", lambda names, values, own=partitions._spec: (
                broken() if values == ("0",) else own(names, values)
            ))
        with pytest.raises(RuntimeError, match="away"):
            update_flag(spark, table, "flag = '0'", place)
    assert update_flag(spark, table, "flag = '0'", place) == 4
    assert tuples(spark.table(table).select("id", "flag")) == [
        (1, "1"), (2, "1"), (3, "1"), (4, "1"), (5, None)
    ]
    assert shown(spark, table) == {"flag=1", "flag=__HIVE_DEFAULT_PARTITION__"}


def test_a_run_is_there_once(spark, df, table, tmp_path):
    place = str(tmp_path / "t")
    assert save_run(df, table, place, "r1") == 5
    assert save_run(df.where("id < 3"), table, place, "r1") == 5
    assert save_run(df.where("id < 3"), table, place, "r2") == 2
    assert tuples(published_runs(spark, table)) == [("r1",), ("r2",)]
    assert spark.table(table).groupBy(RUN).count().orderBy(RUN).collect() == [("r1", 5), ("r2", 2)]
    with pytest.raises(EmptyWriteError):
        save_run(df.where("id > 99"), table, place, "r3")
    with pytest.raises(ValueError, match="name"):
        save_run(df, table, place, "a/b")
    with pytest.raises(SchemaMismatchError, match="city"):
        save_run(df.drop("city"), table, place, "r4")
    assert published_runs(spark, table).count() == 2


def test_a_write_that_failed_leaves_nothing_to_be_seen(spark, df, table, tmp_path):
    place = str(tmp_path / "t")
    broken = df.withColumn("flag", F.when(F.col("id") == 5, F.raise_error(F.lit("late")))
                           .otherwise(F.col("flag")))
    with pytest.raises(Exception, match="late"):
        save_run(broken.repartition(5), table, place, "r1")
    assert spark.table(table).count() == 0
    assert save_run(df, table, place, "r1") == 5
    assert spark.table(table).count() == 5


def test_a_run_with_partitions_of_its_own(spark, df, table, tmp_path, monkeypatch):
    place = str(tmp_path / "t")
    register = runs.register

    def some(spark, table, names, found, replace=False):
        register(spark, table, names, found[:2], replace)
        raise RuntimeError("the catalog is away")

    with monkeypatch.context() as patch:
        patch.setattr(runs, "register", some)
        with pytest.raises(RuntimeError, match="away"):
            save_run(df, table, place, "r1", partitions=["city"])
    assert len(shown(spark, table)) == 2
    for _ in range(2):
        assert save_run(df, table, place, "r1", partitions=["city"]) == 5
    assert save_run(df, table, place, "r2", partitions=["city"]) == 5
    assert len(shown(spark, table)) == 8
    assert tuples(spark.table(table).where(f"{RUN} = 'r2'").select("id", "flag", "city")) == (
        ordered(ROWS)
    )


def test_a_table_without_runs_is_refused(spark, df, table, tmp_path):
    save(df, table, str(tmp_path / "t"))
    with pytest.raises(SchemaMismatchError, match=RUN):
        save_run(df, table, str(tmp_path / "t"), "r1")
    with pytest.raises(SchemaMismatchError, match="of their own"):
        save_run(df.withColumn(RUN, F.lit("x")), f"{table}_2", str(tmp_path / "u"), "r1")
