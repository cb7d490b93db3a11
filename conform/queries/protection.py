"""Hashing, encryption and the vault of known keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.functions import cipher_key, decrypt, encrypt
from conform.operators import control_pairs, hash_and_drop, new_keys, protect, vault_delta
from conform.operators.protect import CIPHER, HASH, VAULT_SCHEMA
from conform.queries.registry import fresh_name, query, scratch, table
from conform.queries.shared import TRIAL_KEY, catalog_table
from conform.sinks import compact_vault, create_vault, insert
from conform.sources import read_table_or_empty, rows_frame


@query(
    """
    select c_nationkey, c_acctbal,
           sha256(c_mktsegment || cast(c_custkey as varchar)) as identity
    from customer
    """
)
def hash_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_and_drop(
        table(spark, sf_dir, "customer"),
        ["c_mktsegment", "c_custkey"],
        "identity",
        drop=["c_mktsegment", "c_custkey", "c_name"],
    )


@query(
    """
    select l_orderkey, l_partkey, l_suppkey, l_linenumber,
           sha256(cast(l_orderkey as varchar) || cast(l_linenumber as varchar)) as "HashValue1",
           sha256(cast(l_partkey as varchar) || cast(l_suppkey as varchar)) as "HashValue2"
    from lineitem
    """
)
def hash_tuples(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"
    )
    return protect(lines, [["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey"]])


@query(
    """
    select c_acctbal, sha256(c_name || c_mktsegment) as "HashValue1",
           sha256(cast(c_custkey as varchar) || cast(c_nationkey as varchar)) as "HashValue2"
    from customer
    """,
    name="control_pairs",
)
def controlled_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    control = rows_frame(
        spark,
        [("1", "c_name", "c_mktsegment"), ("2", "c_custkey", "c_nationkey")],
        "id string, first string, second string",
    )
    return protect(table(spark, sf_dir, "customer"), control_pairs(control), drop=True)


@query(
    """
    select c_custkey, plain,
           cast(coalesce(4 * ceil(16 * (length(plain) // 16 + 1) / 3), 0) as int) as size
    from (select c_custkey, c_mktsegment || cast(c_custkey as varchar) as plain from customer)
    """
)
def encrypt_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    key = cipher_key(spark, TRIAL_KEY)
    return protect(customers, [["c_mktsegment", "c_custkey"]], key).select(
        "c_custkey",
        decrypt(F.col("AESValue"), key).alias("plain"),
        F.length("AESValue").alias("size"),
    )


@query("select s_suppkey, s_name as plain from supplier")
def encrypt_random(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = cipher_key(spark, TRIAL_KEY)
    return (
        table(spark, sf_dir, "supplier")
        .select("s_suppkey", encrypt(F.col("s_name"), key, "GCM").alias("cipher"))
        .select("s_suppkey", decrypt(F.col("cipher"), key, "GCM").alias("plain"))
    )


@query(
    """
    select c_custkey, sha256(c_name) as "HashValue1",
           cast(coalesce(4 * ceil(16 * (length(c_name) // 16 + 1) / 3), 0) as int) as size
    from customer
    """
)
def encrypt_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    protected = protect(customers, [["c_name"]], TRIAL_KEY, drop=True)
    return protected.select("c_custkey", "HashValue1", F.length("AESValue").alias("size"))


def _overdrawn_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "customer")
        .where(F.col("c_acctbal") < 0)
        .select(F.sha2(F.col("c_custkey").cast("string"), 256).alias(HASH))
    )


_NEW_SQL = """
    select {distinct} sha256(cast(o_custkey as varchar)) as hashvalue,
           'order of ' || o_custkey as aesvalue
    from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0)
"""


def _order_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("o_custkey").cast("string")
    return table(spark, sf_dir, "orders").select(
        F.sha2(text, 256).alias("HashValue1"), F.concat(F.lit("order of "), text).alias("AESValue1")
    )


@query(_NEW_SQL.format(distinct=""), name="new_keys")
def unseen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_keys(_order_keys(spark, sf_dir), _overdrawn_vault(spark, sf_dir))


@query(_NEW_SQL.format(distinct="distinct"))
def new_keys_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_keys(_order_keys(spark, sf_dir), _overdrawn_vault(spark, sf_dir), dedup=True)


@query(_NEW_SQL.format(distinct=""))
def new_keys_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    vault = fresh_name("vault")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    create_vault(spark, vault, scratch(spark, "vault"), buckets)
    known = _overdrawn_vault(spark, sf_dir).withColumn(CIPHER, F.lit("known"))
    insert(known, vault)
    return new_keys(_order_keys(spark, sf_dir), spark.table(vault), bucketed=True)


_GROWN_SQL = """
    select sha256(plain) as hashvalue, plain
    from (select distinct cast(o_custkey as varchar) as plain from orders
          union select cast(c_custkey as varchar) from customer where c_acctbal < 0)
    where plain is not null
"""


@query(_GROWN_SQL, name="vault_delta")
def grown_vault(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = cipher_key(spark, TRIAL_KEY)
    overdrawn, orders = _two_loads(spark, sf_dir)
    none = read_table_or_empty(spark, "no_vault_yet", VAULT_SCHEMA)
    vault = catalog_table(spark, vault_delta(overdrawn, [["custkey"]], key, none), "vault")
    insert(vault_delta(orders, [["custkey"]], key, spark.table(vault)), vault)
    return spark.table(vault).select(HASH, decrypt(F.col(CIPHER), key).alias("plain"))


@query(_GROWN_SQL)
def vault_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = cipher_key(spark, TRIAL_KEY)
    vault = fresh_name("vault")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    create_vault(spark, vault, scratch(spark, "vault"), buckets)
    for load in _two_loads(spark, sf_dir):
        insert(vault_delta(load, [["custkey"]], key, spark.table(vault)), vault)
    return spark.table(vault).select(HASH, decrypt(F.col(CIPHER), key).alias("plain"))


@query(_GROWN_SQL)
def vault_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both loads find the vault as it was before either, and add what they share twice."""
    key = cipher_key(spark, TRIAL_KEY)
    vault = fresh_name("vault")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    create_vault(spark, vault, scratch(spark, "vault"), buckets)
    none = read_table_or_empty(spark, "no_vault_yet", VAULT_SCHEMA)
    for load in _two_loads(spark, sf_dir):
        insert(vault_delta(load, [["custkey"]], key, none), vault)
    compact_vault(spark, vault, scratch(spark, "compacted"))
    return spark.table(vault).select(HASH, decrypt(F.col(CIPHER), key).alias("plain"))


def _two_loads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    overdrawn = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    orders = table(spark, sf_dir, "orders")
    return (
        overdrawn.select(F.col("c_custkey").alias("custkey")),
        orders.select(F.col("o_custkey").alias("custkey")),
    )
