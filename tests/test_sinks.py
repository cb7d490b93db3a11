from __future__ import annotations

import uuid

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from conform.operators import vault_delta
from conform.sinks import (
    EmptyWriteError,
    SchemaMismatchError,
    create_vault,
    flagged,
    insert,
    move,
    overwrite_partitions,
    save,
    update_flag,
    write_partitioned,
)
from conform.sources import rows_frame
from tests.data import tuples

SCHEMA = "id int, city string, flag string"
ROWS = [(1, "Cali", "0"), (2, "Bogotá", "0"), (3, "Cali", None), (4, None, "0")]


@pytest.fixture
def df(spark):
    return rows_frame(spark, ROWS, SCHEMA)


@pytest.fixture
def table(spark):
    name = f"sink_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"drop table if exists {name}")


def files(path) -> set[str]:
    return {entry.name for entry in path.iterdir() if not entry.name.startswith(("_", "."))}


def test_write_partitioned(spark, tmp_path):
    df = rows_frame(spark, [(1, "N/A"), (2, "Maestro"), (3, "Maestro")], "id int, SCHEMA string")
    out = tmp_path / "out"
    for cluster in (True, False):
        assert write_partitioned(df, str(out), ["SCHEMA"], cluster) == 3
        assert files(out) == {"SCHEMA=N%2FA", "SCHEMA=Maestro"}
        assert tuples(spark.read.parquet(str(out))) == [(1, "N/A"), (2, "Maestro"), (3, "Maestro")]


def test_partitioned_writes_keep_files_open_instead_of_sorting(spark, tmp_path):
    name, out = "spark.sql.maxConcurrentOutputFileWriters", str(tmp_path / "out")
    seen = F.udf(lambda _: TaskContext.get().getLocalProperty(name))
    rows = spark.range(0, 300, 1, 2).withColumn("writers", seen("id"))
    for routes in (3, 20):
        routed = rows.withColumn("route", F.col("id") % routes)
        for write in (
            lambda: write_partitioned(routed, out, ["route"], cluster=False),
            lambda: overwrite_partitions(routed, out, ["route"]),
        ):
            assert write() == 300
            written = spark.read.parquet(out)
            assert [tuple(r) for r in written.select("writers").distinct().collect()] == [("4",)]
            pairs = written.orderBy("id").select("id", "route").collect()
            assert [tuple(r) for r in pairs] == [(n, n % routes) for n in range(300)]
    assert spark.conf.get(name, None) is None


def test_a_number_of_writers_that_the_session_has_stays(spark, tmp_path):
    name, out = "spark.sql.maxConcurrentOutputFileWriters", str(tmp_path / "out")
    seen = F.udf(lambda _: TaskContext.get().getLocalProperty(name))
    rows = spark.range(5).withColumn("writers", seen("id")).withColumn("route", F.lit(1))
    spark.conf.set(name, "7")
    try:
        write_partitioned(rows, out, ["route"])
        assert spark.conf.get(name) == "7"
    finally:
        spark.conf.unset(name)
    assert spark.read.parquet(out).first()["writers"] == "7"


def test_overwriting_replaces_everything_or_only_some_partitions(spark, df, tmp_path):
    out = str(tmp_path / "out")
    write_partitioned(df, out, ["city"])
    cali = df.where("city = 'Cali'").withColumn("flag", F.lit("9"))
    assert overwrite_partitions(cali, out, ["city"]) == 2
    flags = spark.read.parquet(out).select("id", "flag")
    assert tuples(flags) == [(1, "9"), (2, "0"), (3, "9"), (4, "0")]
    assert write_partitioned(cali, out, ["city"]) == 2
    assert spark.read.parquet(out).count() == 2


@pytest.mark.parametrize("partitions", [(), ("city",)])
def test_save_creates_and_appends(spark, df, table, tmp_path, partitions):
    location = tmp_path / "t"
    assert save(df, table, str(location), partitions=partitions) == 4
    assert save(df, table, str(tmp_path / "unused"), partitions=partitions) == 4
    assert spark.table(table).count() == 8
    assert location.exists() and not (tmp_path / "unused").exists()
    described = spark.sql(f"describe extended {table}").where("col_name = 'Type'")
    assert described.first()["data_type"] == "EXTERNAL"


def test_save_in_another_format(spark, df, table, tmp_path):
    assert save(df, table, str(tmp_path / "t"), "orc") == 4
    assert tuples(spark.table(table)) == tuples(df)


def test_no_rows_are_refused(spark, df, table, tmp_path):
    none = df.where("id > 100")
    with pytest.raises(EmptyWriteError):
        save(none, table, str(tmp_path / "t"))
    assert not spark.catalog.tableExists(table)
    save(df, table, str(tmp_path / "u"))
    for refused in (lambda: save(none, table, ""), lambda: insert(none, table)):
        with pytest.raises(EmptyWriteError):
            refused()
    assert spark.table(table).count() == 4


@pytest.mark.parametrize("partitions", [(), ("city",)])
def test_insert_goes_by_name(spark, df, table, tmp_path, partitions):
    save(df, table, str(tmp_path / "t"), partitions=partitions)
    shuffled = df.select(
        "flag", F.lit("more").alias("extra"), "city", (F.col("id") + 10).alias("ID")
    )
    with pytest.raises(SchemaMismatchError, match="extra"):
        insert(shuffled, table)
    assert insert(shuffled, table, drop_others=True) == 4
    assert tuples(spark.table(table).select("id", "city").where("id > 10")) == [
        (11, "Cali"), (12, "Bogotá"), (13, "Cali"), (14, None)
    ]


def test_insert_needs_every_column(df, table, tmp_path):
    save(df, table, str(tmp_path / "t"))
    with pytest.raises(SchemaMismatchError, match="city"):
        insert(df.drop("city"), table)


def test_move_checks_the_schema(spark, df, table, tmp_path):
    location = str(tmp_path / "t")
    assert move(df, table, location) == 4
    assert move(df, table, location) == 4
    for other in (df.select("city", "id", "flag"), df.withColumn("id", F.col("id").cast("long"))):
        with pytest.raises(SchemaMismatchError):
            move(other, table, location)
    certain = df.withColumn("flag", F.lit("1"))
    with pytest.raises(SchemaMismatchError):
        move(certain, table, location)
    assert move(certain, table, location, strict=False) == 4
    assert spark.table(table).count() == 12


def test_move_goes_on_where_a_middle_column_partitions(spark, df, table, tmp_path):
    for _ in range(3):
        assert move(df, table, str(tmp_path / "t"), partitions=["city"]) == 4
    assert spark.table(table).columns == ["id", "flag", "city"]
    assert spark.table(table).count() == 12


@pytest.mark.parametrize("partitions", [(), ("city",)])
def test_update_flag_among_values(spark, df, table, tmp_path, partitions):
    save(df, table, str(tmp_path / "t"), partitions=partitions)
    places = rows_frame(spark, [("Cali",), ("Cali",), (None,)], "place string")
    update_flag(spark, table, "id < 9", str(tmp_path / "new's"), among=[("city", places)])
    assert tuples(spark.table(table).select("id", "flag")) == [
        (1, "1"), (2, "0"), (3, "1"), (4, "0")
    ]


def test_flagged_leaves_rows_of_an_unknown_condition(df):
    assert [row.flag for row in flagged(df, "city = 'Cali'").orderBy("id").collect()] == [
        "1", "0", "1", "0"
    ]
    assert flagged(df, F.col("id") == 4, "flag", "x").where("flag = 'x'").count() == 1
    number = flagged(df, "id = 1", flag="id", value="9")
    assert number.dtypes == df.dtypes and number.where("id = 9").count() == 1


FLAGGED = [(1, "Cali", "1"), (2, "Bogotá", "0"), (3, "Cali", None), (4, None, "1")]


def test_update_flag_writes_a_new_snapshot(spark, df, table, tmp_path):
    save(df, table, str(tmp_path / "t"))
    assert update_flag(spark, table, "id in (1, 4)", str(tmp_path / "new")) == 4
    assert tuples(spark.table(table)) == FLAGGED
    assert tuples(spark.read.parquet(str(tmp_path / "t"))) == sorted(ROWS)
    assert insert(df, table) == 4
    assert spark.table(table).count() == 8
    with pytest.raises(Exception, match="(?i)already exists"):
        update_flag(spark, table, "id = 2", str(tmp_path / "new"))
    assert spark.table(table).count() == 8


def test_update_flag_rewrites_only_touched_partitions(spark, df, table, tmp_path):
    save(df, table, str(tmp_path / "t"), partitions=["city"])
    before = {path.name for path in (tmp_path / "t").rglob("*.parquet") if "Bogot" in str(path)}
    assert update_flag(spark, table, "id in (1, 4)", "") == 3
    expected = [(row[0], row[2], row[1]) for row in FLAGGED]
    assert tuples(spark.table(table)) == sorted(
        expected, key=lambda row: [(value is not None, str(value)) for value in row]
    )
    after = {path.name for path in (tmp_path / "t").rglob("*.parquet") if "Bogot" in str(path)}
    assert before == after
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
    assert update_flag(spark, table, "id = 77", "") == 0


def test_a_flag_that_partitions_its_table_needs_a_location(spark, df, table, tmp_path):
    save(df, table, str(tmp_path / "t"), partitions=["flag"])
    with pytest.raises(ValueError, match="partition column"):
        update_flag(spark, table, "id = 1", "")  # without a location
    assert tuples(spark.table(table).select("id")) == tuples(df.select("id"))


def test_update_flag_with_two_partition_columns(spark, df, table, tmp_path):
    more = df.withColumn("year", F.when(F.col("id") < 3, 2020).otherwise(2021))
    save(more, table, str(tmp_path / "t"), partitions=["city", "year"])
    assert update_flag(spark, table, "id in (1, 4)", "") == 2
    assert tuples(spark.table(table).select("id", "city", "flag")) == FLAGGED


def test_touched_partitions_are_pruned_from_the_scan(spark, df, table, tmp_path, capsys):
    from conform.sinks.flags import _affected

    save(df, table, str(tmp_path / "t"), partitions=["city"])
    capsys.readouterr()
    _affected(spark.table(table), "id = 1", ["city"]).explain()
    plan = capsys.readouterr().out
    assert "dynamicpruning" in plan


def test_a_bucketed_vault_is_not_shuffled(spark, table, tmp_path, capsys):
    create_vault(spark, table, str(tmp_path / "v"), 8)
    keys = spark.range(1000).select(F.col("id").alias("id"))
    key = "0123456789abcdef"
    assert insert(vault_delta(keys.where("id < 600"), [["id"]], key, spark.table(table)), table)
    written = len(list((tmp_path / "v").glob("*.parquet")))
    assert written <= 9  # one for each bucket, and the empty one it began with
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        delta = vault_delta(keys, [["id"]], key, spark.table(table))
        assert delta.count() == 400
        capsys.readouterr()
        delta.explain()
        plan = capsys.readouterr().out
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    vault_side = plan[plan.rindex("+- Sort"):]
    assert "Bucketed: true" in vault_side and "Exchange" not in vault_side
    assert insert(delta, table) == 400
    assert spark.table(table).select("hashvalue").distinct().count() == 1000
