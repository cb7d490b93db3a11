"""Inputs that several queries use, each with its SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.queries.registry import fresh_name, scratch, table
from conform.sinks import save

# Codes of market segments; AUTOMOBILE has none.
SEGMENT_CODES = [
    ("BUILDING", "BU"),
    ("MACHINERY", "MA"),
    ("FURNITURE", "FU"),
    ("HOUSEHOLD", "HO"),
]
SEGMENT_CODES_SQL = (
    "select * from (values ('BUILDING', 'BU'), ('MACHINERY', 'MA'), ('FURNITURE', 'FU'), "
    "('HOUSEHOLD', 'HO')) as codes (segment, code)"
)

# A key for trying the cipher. Real keys come from a secret store.
TRIAL_KEY = "0123456789abcdef"

# A rules table made from the values in the tables; a code is a value's abbreviation.
# Customers' rules stand in it for two columns, and other tables' rules beside them,
# for a lookup to sort out.
RULES_SQL = """
    select distinct substr(c_mktsegment, 1, 2) as codigo_id, c_mktsegment as homologacion,
                    'CUSTOMER' as tabla, columna
    from customer cross join (values ('c_mktsegment'), ('segment')) as c (columna)
    where c_mktsegment <> 'AUTOMOBILE'
    union all
    select distinct substr(o_orderpriority, 1, 1), o_orderpriority, 'ORDERS', 'o_orderpriority'
    from orders where o_orderpriority not like '5%'
    union all
    select distinct lower(o_orderstatus), o_orderstatus, 'ORDERS', 'o_orderstatus' from orders
    union all
    select distinct substr(p_type, 1, 3), p_type, 'PART', 'p_type' from part
"""


def rules_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules as a catalog table, whose size Spark knows when it plans a join."""
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    segments = _rules(
        customer.where(F.col("c_mktsegment") != "AUTOMOBILE"),
        "customer",
        "c_mktsegment",
        F.substring("c_mktsegment", 1, 2),
    )
    rules = [
        segments,
        segments.withColumn("columna", F.lit("segment")),
        _rules(
            orders.where(~F.col("o_orderpriority").startswith("5")),
            "orders",
            "o_orderpriority",
            F.substring("o_orderpriority", 1, 1),
        ),
        _rules(orders, "orders", "o_orderstatus", F.lower("o_orderstatus")),
        _rules(part, "part", "p_type", F.substring("p_type", 1, 3)),
    ]
    return spark.table(catalog_table(spark, reduce(DataFrame.unionByName, rules), "rules"))


def _rules(df: DataFrame, name: str, column: str, code: Column) -> DataFrame:
    return df.select(
        code.alias("codigo_id"),
        F.col(column).alias("homologacion"),
        F.lit(name.upper()).alias("tabla"),
        F.lit(column).alias("columna"),
    ).distinct()


def catalog_table(
    spark: SparkSession, df: DataFrame, name: str, partitions: tuple[str, ...] = ()
) -> str:
    """Save rows as a new catalog table in the shared folder; returns its name."""
    unique = fresh_name(name)
    save(df, unique, scratch(spark, name), partitions=partitions)
    return unique
