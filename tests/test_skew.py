"""One key holds a third of the rows: Spark must be able to split it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conform.operators import equi_join, new_keys, standardise, vault_delta
from conform.sinks import create_vault, insert, write_partitioned

# Thresholds small enough for Spark to see this much data as skewed.
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
}


@pytest.fixture(scope="module", autouse=True)
def small_thresholds(spark):
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name in SMALL:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def facts(spark):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 20000)
    return spark.range(0, 120_000, 1, 16).select(
        F.col("id").alias("row"),
        key.cast("bigint").alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("pad"),
    )


@pytest.fixture(scope="module")
def keys(spark):
    return spark.range(0, 30_000, 1, 16).select(
        (F.col("id") + 5).alias("r"), F.sha2(F.col("id").cast("string"), 256).alias("rpad")
    )


def final_plan(df, capsys) -> str:
    df.collect()
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out.split("Initial Plan")[0]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "semi", "anti"])
def test_hot_facts_on_the_left(facts, keys, capsys, how):
    plan = final_plan(equi_join(facts, keys, [("k", "r")], how), capsys)
    assert "skew=true" in plan


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_hot_facts_on_the_right(facts, keys, capsys, how):
    df = equi_join(keys, facts, [("r", "k")], how, hot=("right",))
    assert "skew=true" in final_plan(df, capsys)


@pytest.mark.parametrize("how", ["semi", "anti"])
def test_hot_facts_that_are_only_looked_up_are_cut_to_their_keys(facts, keys, capsys, how):
    plan = final_plan(equi_join(keys, facts, [("r", "k")], how, hot=("right",)), capsys)
    before_the_shuffle = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in before_the_shuffle


@pytest.mark.parametrize("how", ["semi", "anti", "left", "full"])
def test_both_sides_hot(facts, capsys, how):
    other = facts.select(F.col("k").alias("r"), (F.col("row") - 60_000).alias("other"))
    other = other.where("other % 500 = 0").unionByName(
        facts.select(F.lit(20_001).cast("bigint").alias("r"), F.col("row").alias("other"))
    )
    plan = final_plan(equi_join(facts, other, [("k", "r")], how, hot=("left", "right")), capsys)
    assert "skew=true" in plan


@pytest.mark.parametrize("how", ["inner", "left"])
def test_standardise_splits_a_hot_value(facts, keys, capsys, how):
    rules = keys.select(
        F.col("rpad").alias("codigo_id"),
        F.col("r").cast("string").alias("homologacion"),
        F.lit("T").alias("tabla"),
    ).distinct()
    df = facts.withColumn("k", F.col("k").cast("string"))
    assert "skew=true" in final_plan(standardise(df, rules, "k", how), capsys)


def test_new_keys_splits_a_hot_key_of_the_data(facts, keys, capsys):
    data = facts.select(
        F.sha2(F.col("k").cast("string"), 256).alias("HashValue1"), F.col("pad").alias("AESValue1")
    )
    vault = keys.select(F.sha2(F.col("r").cast("string"), 256).alias("hashvalue"))
    assert "skew=true" in final_plan(new_keys(data, vault), capsys)


def test_new_keys_splits_a_hot_key_where_the_vault_is_bucketed(spark, facts, keys, capsys, tmp_path):
    data = facts.select(
        F.sha2(F.col("k").cast("string"), 256).alias("HashValue1"), F.col("pad").alias("AESValue1")
    )
    create_vault(spark, "skew_vault", str(tmp_path / "v"), 8)
    held = keys.where("r > 100").select(F.sha2(F.col("r").cast("string"), 256).alias("hashvalue"))
    insert(held.withColumn("aesvalue", F.lit("c")), "skew_vault")
    vault = spark.table("skew_vault")
    found = new_keys(data, vault, bucketed=True)
    plan = final_plan(found, capsys)
    assert "skew=true" in plan
    scan = plan.index("skew_vault")
    assert "Exchange" not in plan[plan.rindex("SortMergeJoin", 0, scan) : scan].split("FileScan")[-1]
    assert sorted(found.collect()) == sorted(new_keys(data, vault).collect())
    spark.sql("drop table skew_vault")


def test_vault_delta_shuffles_each_key_once_per_task(facts, keys, capsys):
    vault = keys.select(F.sha2(F.col("r").cast("string"), 256).alias("hashvalue"))
    df = vault_delta(facts, [["k"]], "0123456789abcdef", vault)
    assert df.count() == 5  # the keys 0 to 4 are not among those from 5 on
    capsys.readouterr()
    df.explain()
    plan = capsys.readouterr().out
    encrypted, joined = plan.split("SortMergeJoin")
    assert "aesEncrypt" in encrypted and "aesEncrypt" not in joined
    assert joined.split("Generate")[0].count("HashAggregate(keys=[plain") == 2


def test_a_hot_output_partition_is_written_by_several_tasks(spark, facts, tmp_path):
    route = F.when(F.col("k") == 7, "hot").otherwise("other")
    rows = write_partitioned(facts.withColumn("route", route), str(tmp_path / "out"), ["route"])
    assert rows == 120_000
    assert len(list((tmp_path / "out" / "route=hot").glob("*.parquet"))) > 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 120_000
