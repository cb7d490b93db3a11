"""Sources: delimited files, rows in memory, catalog tables, SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructType

from conform.operators import new_keys, rules_for
from conform.operators.protect import VAULT_SCHEMA
from conform.queries.registry import fresh_name, query, scratch, table
from conform.queries.shared import (
    RULES_SQL,
    SEGMENT_CODES,
    SEGMENT_CODES_SQL,
    rules_table,
)
from conform.sources import (
    read_delimited,
    read_delimited_by_header,
    read_delimited_checked,
    read_table,
    read_table_or_empty,
    rows_frame,
    run_sql,
)


def _write_delimited(df: DataFrame, path: str, sep: str) -> str:
    df.write.options(header=True, sep=sep, nullValue="null").csv(path)
    return f"{path}/part-*.csv"


@query(
    """
    select o_orderkey, o_custkey,
           case when o_orderstatus <> 'P' then o_orderstatus end as o_orderstatus,
           o_totalprice, o_orderpriority
    from orders
    """
)
def scan_delimited_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
        "o_totalprice",
        "o_orderpriority",
    )
    path = scratch(spark, "orders")
    shards = orders.withColumn("shard", F.col("o_orderpriority"))
    shards.write.options(header=True, sep="|", nullValue="null").partitionBy("shard").csv(path)
    return read_delimited(spark, f"{path}/shard=*/part-*.csv", "|", orders.schema)


@query("select s_suppkey, s_name, s_nationkey, s_acctbal from supplier")
def scan_delimited_semicolon(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    files = _write_delimited(supplier, scratch(spark, "supplier"), ";")
    return read_delimited(spark, files, ";", supplier.schema)


def _checked_suppliers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Suppliers from files in which the nation of those in debt cannot be read."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    nation = F.when(F.col("s_acctbal") < 0, "none").otherwise(F.col("s_nationkey").cast("string"))
    files = _write_delimited(
        supplier.withColumn("s_nationkey", nation), scratch(spark, "supplier"), ";"
    )
    return read_delimited_checked(spark, files, ";", supplier.schema)


@query(
    """
    select s_suppkey, s_name, s_nationkey, s_acctbal from supplier
    where coalesce(s_acctbal >= 0, true)
    """
)
def scan_delimited_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_suppliers(spark, sf_dir)[0]


@query(
    """
    select s_suppkey, s_name, 'none' as nation, s_nationkey is null as unread,
           'supplier' as folder, 0 as block
    from (select s_suppkey, s_name, cast(null as int) as s_nationkey from supplier
          where s_acctbal < 0)
    """
)
def scan_delimited_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked_suppliers(spark, sf_dir)[1].select(
        "s_suppkey",
        "s_name",
        F.split("rejected_record", ";")[2].alias("nation"),
        F.isnull("s_nationkey").alias("unread"),
        F.regexp_extract("rejected_file", "([^/]*)/[^/]*$", 1).alias("folder"),
        F.col("rejected_block").cast("int").alias("block"),
    )


@query(
    """
    select o_orderkey, case when o_orderpriority < '3' then o_custkey end as o_custkey,
           case when o_orderpriority < '4' then o_totalprice end as o_totalprice, o_orderstatus
    from orders
    """
)
def scan_delimited_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of one glob: some lack columns, some have them in another order."""
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"]
    orders = table(spark, sf_dir, "orders")
    path, priority = scratch(spark, "orders"), F.col("o_orderpriority")
    shards = [
        (priority < "3", columns),
        ((priority >= "3") & (priority < "4"), ["o_totalprice", "o_orderstatus", "o_orderkey"]),
        ((priority >= "4") | priority.isNull(), ["o_orderstatus", "o_shippriority", "o_orderkey"]),
    ]
    for number, (part, names) in enumerate(shards):
        shard = orders.where(part).withColumn("o_shippriority", F.lit(0)).select(*names)
        writer = shard.write.options(header=True, sep="|", nullValue="null")
        writer.csv(f"{path}/shard={number}")
    schema = orders.select(*columns).schema
    return read_delimited_by_header(spark, f"{path}/shard=*/part-*.csv", "|", schema)


@query(
    """
    select cast(p_partkey as int) as p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
    from part
    """
)
def scan_delimited_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = _write_delimited(table(spark, sf_dir, "part"), scratch(spark, "part"), "|")
    return read_delimited(spark, files, "|", infer=True)


@query(
    """
    select cast(o_orderkey as varchar) as o_orderkey, cast(o_custkey as varchar) as o_custkey,
           o_orderstatus, o_orderpriority
    from orders
    """
)
def scan_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    return read_delimited(spark, _write_delimited(orders, scratch(spark, "orders"), "|"), "|")


_PRIORITY_SCHEMA = StructType().add(
    "priority", StructType().add("rank", IntegerType()).add("label", StringType())
).add("expedite", BooleanType())

_PRIORITIES = [
    ((1, "URGENT"), True),
    ((2, "HIGH"), True),
    ((3, "MEDIUM"), False),
    ((4, "NOT SPECIFIED"), None),
    ((5, "LOW"), False),
]


@query(
    """
    select o_orderkey, rank, label, expedite
    from orders
    join (values (1, 'URGENT', true), (2, 'HIGH', true), (3, 'MEDIUM', false),
                 (4, 'NOT SPECIFIED', null), (5, 'LOW', false)) as p (rank, label, expedite)
      on o_orderpriority = rank || '-' || label
    """
)
def rows_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    priorities = rows_frame(spark, _PRIORITIES, _PRIORITY_SCHEMA)
    text = F.concat_ws("-", F.col("priority.rank").cast("string"), F.col("priority.label"))
    return (
        table(spark, sf_dir, "orders")
        .join(priorities, F.col("o_orderpriority") == text)
        .select("o_orderkey", "priority.rank", "priority.label", "expedite")
    )


@query(
    f"""
    select c_custkey, c_mktsegment, code
    from customer join ({SEGMENT_CODES_SQL}) as s on c_mktsegment = segment
    """
)
def rows_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = rows_frame(spark, SEGMENT_CODES, "segment string, code string")
    return (
        table(spark, sf_dir, "customer")
        .join(codes, F.col("c_mktsegment") == F.col("segment"))
        .select("c_custkey", "c_mktsegment", "code")
    )


@query(
    """
    select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
    from orders where o_orderstatus = 'F' and o_totalprice > 100000
    """
)
def scan_table_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = fresh_name("orders")
    spark.catalog.createTable(name, f"{sf_dir}/orders.parquet", "parquet")
    found = read_table(spark, name, "o_orderstatus = 'F' and o_totalprice > 100000")
    return found.drop("o_orderdate")


@query(
    f"""
    select distinct codigo_id, homologacion, tabla from ({RULES_SQL}) as r
    where tabla = 'CUSTOMER'
    """
)
def rules_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules_for(rules_table(spark, sf_dir), "customer")


@query(
    """
    select sha256(c_name) as hashvalue, c_name as aesvalue from customer where c_name is not null
    """
)
def empty_with_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault = read_table_or_empty(spark, fresh_name("vault"), VAULT_SCHEMA)
    customers = table(spark, sf_dir, "customer").select(F.sha2("c_name", 256).alias("h"), "c_name")
    return new_keys(customers, vault, "h", "c_name")


_VIEW_SQL = """
    select o_orderkey, o_totalprice, c_name, c_mktsegment
    from {orders} o join {customer} c on o.o_custkey = c.c_custkey
    where c.c_acctbal < 0
"""


@query(_VIEW_SQL.format(orders="orders", customer="customer"))
def sql_view_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(
        spark,
        _VIEW_SQL,
        orders=table(spark, sf_dir, "orders"),
        customer=table(spark, sf_dir, "customer"),
    )
