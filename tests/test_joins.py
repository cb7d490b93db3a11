from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conform.operators import equi_join
from conform.operators.joins import JOIN_KINDS
from conform.sources import rows_frame
from tests.data import depots, parcels, plan_of, tuples

# rows and columns of the seven parcels joined with the four depots
SIZES = {
    "inner": (5, 7),
    "outer": (8, 7),
    "full": (8, 7),
    "fullouter": (8, 7),
    "right": (6, 7),
    "rightouter": (6, 7),
    "left": (7, 7),
    "leftouter": (7, 7),
    "leftanti": (2, 5),
    "leftsemi": (5, 5),
    "cross": (5, 7),
}
HOT = [(), ("left",), ("right",), ("left", "right")]
PLAIN = {"inner": "inner", "left": "left", "right": "right", "full": "full",
         "semi": "left_semi", "anti": "left_anti"}


@pytest.mark.parametrize("how", SIZES)
def test_sizes(spark, how):
    df = equi_join(parcels(spark), depots(spark), [("depot", "depot_id")], how)
    assert (df.count(), len(df.columns)) == SIZES[how]


def test_names_of_joins(spark):
    assert equi_join(parcels(spark), depots(spark), [("depot", "depot_id")], "LEFT_OUTER").count()
    with pytest.raises(ValueError):
        equi_join(parcels(spark), depots(spark), [("depot", "depot_id")], "asof")
    with pytest.raises(ValueError):
        equi_join(parcels(spark), depots(spark), [("depot", "depot_id")], hot=("both",))
    assert set(JOIN_KINDS.values()) == set(PLAIN)


def test_text_that_is_no_number_matches_nothing(spark):
    more = rows_frame(spark, [(108, "mat", 101, "seven", 1)], parcels(spark).schema)
    sent = parcels(spark).unionByName(more)
    on = [("depot", "depot_id")]
    assert equi_join(sent, depots(spark), on).count() == 5
    assert equi_join(sent, depots(spark), on, "left").count() == 8
    assert equi_join(depots(spark), sent, [("depot_id", "depot")], "anti").count() == 1


def test_a_fraction_matches_a_whole_key_only_if_cut_off(spark):
    texts = rows_frame(spark, [("7.9",), ("7",), ("12.0",)], "depot string")
    for hot in HOT:
        on = [("depot", "depot_id")]
        assert tuples(equi_join(texts, depots(spark), on, "semi", hot)) in ([("7",)], [("12.0",), ("7",)])
        assert ("7.9",) in tuples(equi_join(texts, depots(spark), on, "semi", hot, truncate=True))
        assert ("7.9",) in tuples(equi_join(texts, depots(spark), on, "anti", hot))


def test_a_key_is_cast_once(spark, capsys):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = equi_join(parcels(spark), depots(spark), [("depot", "depot_id")], hot=())
        plan = plan_of(joined, capsys)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "__cast" in plan and not any("__cast" in name for name in joined.columns)
    exchanges = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert exchanges and not any("cast(" in line.lower() for line in exchanges)


def test_text_is_compared_with_a_date_as_a_date(spark):
    texts = rows_frame(spark, [("2020-02-29",), ("29/02/2020",), ("",)], "t string")
    days = spark.sql("select date'2020-02-29' as d")
    assert equi_join(texts, days, [("t", "d")]).count() == 1
    assert equi_join(texts, days, [("t", "d")], "anti").count() == 2


def test_product_and_self_join(spark):
    assert parcels(spark).crossJoin(depots(spark)).count() == 28
    a, b = parcels(spark).alias("a"), parcels(spark).alias("b")
    assert a.join(b, F.col("a.follows") == F.col("b.parcel")).count() == 5
    before = parcels(spark).select(F.col("parcel").alias("id"), F.col("item").alias("earlier"))
    assert equi_join(parcels(spark), before, [("follows", "id")]).count() == 5


@pytest.fixture(scope="module")
def sides(spark):
    """Two sides with one hot key, null keys, and keys of their own."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 != 0, F.col("id") % 400)
    left = spark.range(0, 3000, 1, 8).select(
        F.col("id").alias("row"), key.cast("bigint").alias("k"), (F.col("id") % 2).alias("part")
    )
    right = spark.range(0, 500, 1, 8).select(
        F.when(F.col("id") % 50 == 0, 7).when(F.col("id") % 13 != 0, F.col("id") + 200)
        .cast("bigint").alias("r"),
        (F.col("id") % 2).alias("rpart"),
        F.col("id").alias("rrow"),
    )
    return left, right


@pytest.mark.parametrize("how", PLAIN)
@pytest.mark.parametrize("hot", HOT)
def test_equals_the_plain_join(sides, how, hot):
    left, right = sides
    on = [("k", "r"), ("part", "rpart")][: 1 + len(hot) % 2]
    plain = left.join(right, [left[ours] == right[theirs] for ours, theirs in on], PLAIN[how])
    ours = equi_join(left, right, on, how, hot)
    assert ours.columns == plain.columns
    assert tuples(ours) == tuples(plain)


def test_equal_column_names_on_both_sides(sides):
    left, _ = sides
    other = left.where("part = 1").limit(50)
    for how in ("inner", "full", "right", "anti"):
        joined = equi_join(left, other, [("row", "row")], how)
        assert joined.count() == {"inner": 50, "full": 3000, "right": 50, "anti": 2950}[how]
