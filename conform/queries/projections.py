"""Headers, derived columns, renames, structs, split and combined text."""

from __future__ import annotations

import sys
import unicodedata

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.functions import concat_key, value_map
from conform.operators import (
    add_column,
    clean_headers,
    combine_columns,
    flatten_struct,
    map_arrow,
    map_batches,
    null_column,
    project_like,
    split_to_columns,
)
from conform.queries.registry import query, table
from conform.sources import run_sql


@query(
    """
    select s_suppkey as "SUPPLIER_KEY", s_name as "FULL_NAME", s_acctbal as "ACCOUNT_BALANCE_USD"
    from supplier
    """,
    name="clean_headers",
)
def clean_header_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_headers(
        table(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("SUPPLIER KEY"),
            F.col("s_name").alias("FULL NAME"),
            F.col("s_acctbal").alias("ACCOUNT BALANCE USD"),
        )
    )


@query(
    """
    select l_orderkey, l_linenumber, l_extendedprice, l_discount,
           l_extendedprice * (1 - l_discount) as net_price
    from lineitem
    """,
    name="add_column",
)
def add_derived_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", "l_discount"
    )
    return add_column(lines, "net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))


@query(
    """
    select o_orderkey, case o_orderstatus when 'F' then 'Activo' when 'O' then 'Inactivo'
                                          else 'Unknown' end as status_text
    from orders
    """
)
def case_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = {"F": "Activo", "O": "Inactivo"}
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", value_map(F.col("o_orderstatus"), texts, "Unknown").alias("status_text")
    )


@query(
    """
    select p_partkey, case p_type when 'STANDARD' then 'Estandar' when 'PROMO' then 'Promocion'
                                  when 'ECONOMY' then 'Economico' end as type_text
    from part
    """
)
def case_no_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = {"STANDARD": "Estandar", "PROMO": "Promocion", "ECONOMY": "Economico"}
    return table(spark, sf_dir, "part").select(
        "p_partkey", value_map(F.col("p_type"), texts).alias("type_text")
    )


_ROUTE = """
    case when o_orderstatus = 'F' then 'Maestro'
         when o_orderstatus = 'O' then 'Transaccion'
         else 'N/A' end
"""


@query(f"select o_orderkey, {_ROUTE} as route from orders")
def case_sql_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_ROUTE).alias("route"))


@query(
    """
    select c_custkey as customer, c_name as name, c_nationkey, c_acctbal, c_mktsegment as segment
    from customer
    """
)
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumnsRenamed(
        {"c_custkey": "customer", "c_name": "name", "c_mktsegment": "segment"}
    )


@query(
    """
    select a.c_custkey as id, a.c_name as name, b.n_name as nation
    from customer a join nation b on a.c_nationkey = b.n_nationkey
    """
)
def select_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").alias("a")
    nations = table(spark, sf_dir, "nation").alias("b")
    return customers.join(nations, F.col("a.c_nationkey") == F.col("b.n_nationkey")).select(
        F.col("a.c_custkey").alias("id"),
        F.col("a.c_name").alias("name"),
        F.col("b.n_name").alias("nation"),
    )


@query("select l_orderkey, l_partkey, l_linenumber, l_quantity from lineitem")
def drop_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").drop(
        "l_suppkey",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )


@query("select s_suppkey, s_name, 'USA' as country from supplier")
def literal_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", "s_name")
        .withColumn("country", F.lit("USA"))
    )


@query(
    """
    select c_custkey, cast(c_acctbal as varchar) as balance, c_acctbal * -1 as copied
    from customer
    """
)
def derive_negated(spark: SparkSession, sf_dir: str) -> DataFrame:
    balances = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_acctbal").cast("string").alias("balance")
    )
    return balances.withColumn("copied", F.col("balance").try_cast("double") * -1)


@query("select c_custkey, c_acctbal * 100 as c_acctbal, c_mktsegment from customer")
def transform_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .select("c_custkey", "c_acctbal", "c_mktsegment")
        .withColumn("c_acctbal", F.col("c_acctbal") * 100)
    )


@query(
    """
    select c_custkey, cast(string_split(c_name, '#')[2] as int) as number from customer
    """
)
def cast_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    numbers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.get(F.split("c_name", "#"), F.lit(1)).alias("number")
    )
    return numbers.withColumn("number", F.col("number").try_cast("int"))


_PERSON_SQL = """
    select c_custkey, c_acctbal * 100 as acctbal, c_acctbal * -1 as copied, 'USA' as country
    from {person}
"""


@query(_PERSON_SQL.format(person="customer"))
def sql_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_sql(spark, _PERSON_SQL, person=table(spark, sf_dir, "customer"))


def _named_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind, number = (F.get(F.split("c_name", "#"), F.lit(index)) for index in (0, 1))
    name = F.struct(kind.alias("kind"), number.alias("number"), F.col("c_mktsegment").alias("tag"))
    return table(spark, sf_dir, "customer").select("c_custkey", name.alias("name"), "c_acctbal")


@query("select c_custkey, string_split(c_name, '#')[1] as kind from customer")
def struct_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_customers(spark, sf_dir).select("c_custkey", "name").select(
        "c_custkey", "name.kind"
    )


@query(
    """
    select c_custkey, string_split(c_name, '#')[1] as kind, string_split(c_name, '#')[2] as number,
           c_mktsegment as tag, c_acctbal
    from customer
    """
)
def struct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten_struct(_named_customers(spark, sf_dir), "name")


@query(
    """
    select string_split(c_name, '#')[1] as kind, string_split(c_name, '#')[2] as number,
           c_mktsegment as tag, c_acctbal as salary
    from customer
    """
)
def nested_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _named_customers(spark, sf_dir).select("name.*", F.col("c_acctbal").alias("salary"))


@query(
    """
    select p_partkey, string_split(p_name, ' ')[1] as adjective,
           string_split(p_name, ' ')[2] as noun, string_split(p_name, ' ')[3] as rest
    from part
    """,
    name="split_to_columns",
)
def split_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return split_to_columns(parts, "p_name", ["adjective", "noun", "rest"], " ")


@query(
    """
    select l_linenumber,
           l_returnflag || cast(l_orderkey as varchar) || cast(l_linenumber as varchar) as line_key,
           l_returnflag || '-' || cast(l_orderkey as varchar) as order_key
    from lineitem
    """,
    name="concat_key",
)
def concat_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_linenumber",
        concat_key(["l_returnflag", "l_orderkey", "l_linenumber"]).alias("line_key"),
        concat_key(["l_returnflag", "l_orderkey"], "-").alias("order_key"),
    )


@query("select s_suppkey, s_name, cast(null as int) as s_acctbal from supplier", name="null_column")
def null_out_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return null_column(suppliers, "s_acctbal", "int")


@query(
    """
    select p_partkey, p_brand || ',' || p_type || ',' || p_name as full_name, p_size from part
    """
)
def combine_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", "p_brand", "p_type", "p_name", "p_size"
    )
    return combine_columns(parts, ["p_brand", "p_type", "p_name"], "full_name")


@query(
    """
    select c_custkey, upper(string_split(c_name, '#')[1]) as kind,
           string_split(c_name, '#')[2] as number
    from customer
    """
)
def map_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pieces(batch: pd.DataFrame, _: None) -> pd.DataFrame:
        split = batch["c_name"].str.split("#", n=1)
        return pd.DataFrame(
            {
                "c_custkey": batch["c_custkey"],
                "kind": split.str[0].str.upper(),
                "number": split.str[1],
            }
        )

    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return map_batches(customers, pieces, "c_custkey bigint, kind string, number string")


@query(
    """
    select p_partkey, p_brand || ',' || p_type || ',' || p_name as full_name from part
    """
)
def map_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    def separator() -> str:
        return ","

    def combine(batch: pd.DataFrame, sep: str) -> pd.DataFrame:
        full = batch["p_brand"].str.cat([batch["p_type"], batch["p_name"]], sep=sep)
        return pd.DataFrame({"p_partkey": batch["p_partkey"], "full_name": full})

    parts = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type", "p_name")
    return map_batches(parts, combine, "p_partkey bigint, full_name string", setup=separator)


@query(
    """
    select doc_id, sha256(strip_accents(text)) as plain_sha256,
           length(text) - length(strip_accents(text)) as shorter
    from documents
    """,
    name="map_arrow",
)
def plain_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without accents: Spark has no expression for Unicode's normal forms."""

    def marks() -> dict[int, None]:
        every = range(sys.maxunicode + 1)
        return {code: None for code in every if unicodedata.category(chr(code)) == "Mn"}

    def plain(batch: pa.RecordBatch, dropped: dict[int, None]) -> pa.RecordBatch:
        texts = [
            None if text is None else unicodedata.normalize("NFD", text).translate(dropped)
            for text in batch.column("text").to_pylist()
        ]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array(texts, pa.string())],
            names=["doc_id", "text", "plain"],
        )

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = map_arrow(documents, plain, "doc_id bigint, text string, plain string", marks)
    return found.select(
        "doc_id",
        F.sha2("plain", 256).alias("plain_sha256"),
        (F.length("text") - F.length("plain")).cast("bigint").alias("shorter"),
    )


@query("select * from customer")
def project_to_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    shuffled = customers.select(*sorted(customers.columns, reverse=True)).withColumn(
        "extra", F.lit(1)
    )
    return project_like(shuffled, customers)
