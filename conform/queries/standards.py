"""Standardising columns through rules made from the tables themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.operators import (
    control_columns,
    rule_conflicts,
    rules_for,
    standardise,
    standardise_any,
    unmatched_values,
)
from conform.plans.protected import standardise_columns
from conform.queries.registry import query, table
from conform.queries.shared import RULES_SQL, catalog_table, rules_table
from conform.sources import rows_frame


@query(
    """
    select c_custkey, c_name, c_nationkey, c_acctbal, substr(c_mktsegment, 1, 2) as c_mktsegment
    from customer where c_mktsegment <> 'AUTOMOBILE'
    """
)
def homologate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_for(rules_table(spark, sf_dir), "customer")
    return standardise(table(spark, sf_dir, "customer"), rules, "c_mktsegment")


@query(
    """
    select c_custkey, c_name, c_nationkey, c_acctbal,
           case when c_mktsegment <> 'AUTOMOBILE' then substr(c_mktsegment, 1, 2) end
               as c_mktsegment
    from customer
    """
)
def homologate_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_for(rules_table(spark, sf_dir), "customer")
    return standardise(table(spark, sf_dir, "customer"), rules, "c_mktsegment", "left")


@query(
    """
    select c_mktsegment, count(*) as "rows" from customer
    where c_mktsegment = 'AUTOMOBILE' or c_mktsegment is null group by c_mktsegment
    """
)
def homologate_unmatched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = rules_for(rules_table(spark, sf_dir), "customer")
    return unmatched_values(table(spark, sf_dir, "customer"), rules, "c_mktsegment")


_SPELLED_SQL = """
    select c_custkey,
           case when c_acctbal < 0 then lower(c_mktsegment)
                when c_acctbal < 3000 then substr(c_mktsegment, 1, 2)
                when c_acctbal < 6000 then substr(c_mktsegment, 1, 4)
                else c_mktsegment end as segment
    from customer
"""

_SPELLINGS_SQL = """
    select distinct c_mktsegment as a, lower(c_mktsegment) as b, substr(c_mktsegment, 1, 2) as c,
           substr(c_mktsegment, 1, 3) as d, c_mktsegment as e, upper(c_mktsegment) as f,
           cast(null as varchar) as g, substr(c_mktsegment, 1, 1) as code
    from customer
"""


@query(
    f"""
    select s.c_custkey, r.code as segment
    from ({_SPELLED_SQL}) as s
    join ({_SPELLINGS_SQL}) as r
      on s.segment = r.a or s.segment = r.b or s.segment = r.c or s.segment = r.d
         or s.segment = r.e or s.segment = r.f or s.segment = r.g
    """
)
def homologate_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    segment, balance = F.col("c_mktsegment"), F.col("c_acctbal")
    spelled = customer.select(
        "c_custkey",
        F.when(balance < 0, F.lower(segment))
        .when(balance < 3000, F.substring(segment, 1, 2))
        .when(balance < 6000, F.substring(segment, 1, 4))
        .otherwise(segment)
        .alias("segment"),
    )
    spellings = customer.select(
        segment.alias("a"),
        F.lower(segment).alias("b"),
        F.substring(segment, 1, 2).alias("c"),
        F.substring(segment, 1, 3).alias("d"),
        segment.alias("e"),
        F.upper(segment).alias("f"),
        F.lit(None).cast("string").alias("g"),
        F.substring(segment, 1, 1).alias("code"),
    ).distinct()
    rules = spark.table(catalog_table(spark, spellings, "spellings"))
    return standardise_any(spelled, rules, "segment", list("abcdefg"), "code")


@query(
    f"""
    with rules as (select distinct codigo_id, homologacion, columna from ({RULES_SQL}) as r
                   where tabla = 'ORDERS')
    select o_orderkey, o_custkey, p.codigo_id as o_orderpriority, s.codigo_id as o_orderstatus
    from orders
    join rules as p on p.columna = 'o_orderpriority' and p.homologacion = o_orderpriority
    join rules as s on s.columna = 'o_orderstatus' and s.homologacion = o_orderstatus
    """,
    name="control_columns",
)
def controlled_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = rows_frame(
        spark,
        [("1", "ORDERS", "o_orderpriority"), ("2", "ORDERS", "o_orderstatus")],
        "id string, tabla string, columna string",
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus"
    )
    rules = rules_table(spark, sf_dir)
    return standardise_columns(orders, rules, "orders", control_columns(control), by_column=True)


# Two codes for each segment that begins with a letter up to H, none for AUTOMOBILE.
_DOUBLE_SQL = """
    select distinct code as codigo_id, c_mktsegment as homologacion
    from (select c_mktsegment, substr(c_mktsegment, 1, 2) as code from customer
          union all
          select c_mktsegment, lower(substr(c_mktsegment, 1, 2)) from customer
          where c_mktsegment < 'I')
    where c_mktsegment <> 'AUTOMOBILE'
"""


def _double_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.col("c_mktsegment")
    code = F.substring(segment, 1, 2)
    codes = F.array(code, F.when(segment < "I", F.lower(code)))
    customers = table(spark, sf_dir, "customer").where(segment != "AUTOMOBILE")
    rules = customers.select(
        F.explode(F.array_compact(codes)).alias("codigo_id"),
        segment.alias("homologacion"),
        F.lit("CUSTOMER").alias("tabla"),
    )
    return rules_for(rules, "customer")


@query(
    f"""
    select c_custkey, c_name, c_nationkey, c_acctbal, min(codigo_id) as c_mktsegment
    from customer join ({_DOUBLE_SQL}) as r on homologacion = customer.c_mktsegment
    group by all
    """
)
def homologate_first_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _double_rules(spark, sf_dir)
    customers = table(spark, sf_dir, "customer")
    return standardise(customers, rules, "c_mktsegment", conflicts="first")


@query(
    f"""
    select c_custkey, c_name, c_nationkey, c_acctbal, code as c_mktsegment
    from customer left join (
        select homologacion, min(codigo_id) as code from ({_DOUBLE_SQL}) as r
        group by homologacion having count(*) = 1) as r on homologacion = c_mktsegment
    """
)
def homologate_conflicts_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = _double_rules(spark, sf_dir)
    customers = table(spark, sf_dir, "customer")
    return standardise(customers, rules, "c_mktsegment", "left", conflicts="report")


@query(
    f"""
    select homologacion, count(*) as codes, min(codigo_id) as first, max(codigo_id) as last
    from ({_DOUBLE_SQL}) as r group by homologacion having count(*) > 1
    """,
    name="rule_conflicts",
)
def conflicting_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_conflicts(_double_rules(spark, sf_dir))
