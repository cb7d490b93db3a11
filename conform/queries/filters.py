"""Predicates, counts and distinct rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.queries.registry import query, table


@query("select * from orders where o_orderstatus = 'F'")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F")


@query("select * from orders where o_orderpriority = '1-URGENT'")
def filter_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").filter("o_orderpriority == '1-URGENT'")


@query("select * from lineitem where l_returnflag = 'A' and l_linestatus = 'F'")
def filter_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").filter(
        (F.col("l_returnflag") == "A") & (F.col("l_linestatus") == "F")
    )


@query(
    """
    select p_partkey, p_name from part where list_contains(string_split(p_name, ' '), 'ring')
    """
)
def filter_array_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select("p_partkey", "p_name").filter(
        F.array_contains(words, "ring")
    )


@query(
    """
    select c_custkey, c_mktsegment as segment, c_nationkey as nation
    from customer where c_mktsegment = 'BUILDING'
    """
)
def filter_struct_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    profile = F.struct(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", profile.alias("profile"))
        .filter(F.col("profile.segment") == "BUILDING")
        .select("c_custkey", "profile.*")
    )


@query(
    """
    select o_orderkey, o_orderstatus, marked
    from (select o_orderkey, o_orderstatus,
                 case when o_orderstatus = 'F' then 'F'
                      when o_orderstatus = 'O' then 'X' end as marked
          from orders) as o
    where o_orderstatus is distinct from marked or marked is null
    """
)
def filter_distinct_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    status, marked = F.col("o_orderstatus"), F.col("marked")
    return (
        table(spark, sf_dir, "orders")
        .select(
            "o_orderkey",
            status,
            F.when(status == "F", "F").when(status == "O", "X").alias("marked"),
        )
        .filter(~status.eqNullSafe(marked) | marked.isNull())
    )


@query(
    """
    select o_orderkey, cast(substr(o_orderpriority, 1, 1) as int) as rank
    from orders where o_orderstatus = 'P' and o_orderpriority is not null
    """
)
def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("o_orderstatus") == "P", F.substring("o_orderpriority", 1, 1))
    return (
        table(spark, sf_dir, "orders")
        .select("o_orderkey", text.try_cast("int").alias("rank"))
        .filter("rank is not null")
    )


_COUNTED = ("customer", "supplier", "part", "orders", "lineitem", "events", "documents")


@query(
    " union all ".join(
        f"select '{name}' as table_name, count(*) as n_rows from {name}" for name in _COUNTED
    )
)
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = [
        table(spark, sf_dir, name)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows")
        for name in _COUNTED
    ]
    return reduce(DataFrame.unionByName, counts)


@query("select distinct l_returnflag, l_linestatus, l_linenumber from lineitem")
def distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_returnflag", "l_linestatus", "l_linenumber")
        .distinct()
    )
