"""Writers: each query writes, and returns what it reads back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.queries.registry import fresh_name, query, scratch, table
from conform.queries.shared import catalog_table
from conform.sinks import (
    EmptyWriteError,
    flagged,
    insert,
    move,
    overwrite_partitions,
    replace_partitions,
    save,
    update_flag,
    write_partitioned,
)
from conform.sources import rows_frame

_ROUTE = """
    case when o_orderstatus = 'F' then 'Maestro'
         when o_orderstatus = 'O' then 'Transaccion'
         else 'N/A' end
"""
_COLUMNS = ["o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"]


def _orders(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*_COLUMNS, *more)


@query(f"select {', '.join(_COLUMNS)}, {_ROUTE} as route from orders")
def sink_partitioned_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "orders")
    routed = _orders(spark, sf_dir, "o_orderstatus").withColumn("route", F.expr(_ROUTE))
    write_partitioned(routed.drop("o_orderstatus"), path, ["route"])
    return spark.read.parquet(path)


@query(
    f"""
    select {", ".join(_COLUMNS)}, case when o_orderstatus = 'P' then 'again' else 'first' end
           as load, o_orderstatus
    from orders
    """
)
def sink_dynamic_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "orders")
    orders = _orders(spark, sf_dir, "o_orderstatus")
    write_partitioned(orders.withColumn("load", F.lit("first")), path, ["o_orderstatus"])
    pending = orders.where(F.col("o_orderstatus") == "P").withColumn("load", F.lit("again"))
    overwrite_partitions(pending, path, ["o_orderstatus"])
    return spark.read.parquet(path)


@query("select c_custkey, c_name, c_acctbal, c_mktsegment from customer")
def sink_save_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = fresh_name("customer"), scratch(spark, "customer")
    customer = table(spark, sf_dir, "customer").drop("c_nationkey")
    overdrawn = F.coalesce(F.col("c_acctbal") < 0, F.lit(False))
    for part in (overdrawn, ~overdrawn):
        save(customer.where(part), name, location, partitions=["c_mktsegment"])
    return spark.table(name)


@query("select * from supplier")
def sink_insert_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    name, location = fresh_name("supplier"), scratch(spark, "supplier")
    spark.catalog.createTable(name, location, "parquet", supplier.schema)
    insert(supplier.select("s_acctbal", "s_nationkey", "s_name", "s_suppkey"), name)
    return spark.table(name)


@query(
    """
    select 'lineitem' as target, count(*) as rows_written, false as refused from lineitem
    union all
    select 'nothing', 0, true
    """
)
def sink_guard_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    results = []
    for target, rows in (("lineitem", lines), ("nothing", lines.where("l_linenumber < 0"))):
        try:
            written = save(rows, fresh_name(target), scratch(spark, target))
            results.append((target, written, False))
        except EmptyWriteError:
            results.append((target, 0, True))
    return rows_frame(spark, results, "target string, rows_written bigint, refused boolean")


_FLAGGED_SQL = f"""
    select {", ".join(_COLUMNS)}, o_orderstatus,
           case when o_orderstatus = 'P' and o_totalprice > 100000 then '1' else '0' end as flag
    from orders
"""
_FLAG_CONDITION = "o_orderstatus = 'P' and o_totalprice > 100000"


@query(_FLAGGED_SQL)
def flag_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_orderstatus").withColumn("flag", F.lit("0"))
    return flagged(orders, _FLAG_CONDITION)


def _updated(spark: SparkSession, sf_dir: str, partitions: tuple[str, ...]) -> DataFrame:
    orders = _orders(spark, sf_dir, "o_orderstatus").withColumn("flag", F.lit("0"))
    name = catalog_table(spark, orders, "orders", partitions)
    update_flag(spark, name, _FLAG_CONDITION, scratch(spark, "snapshot"))
    return spark.table(name)


@query(_FLAGGED_SQL)
def flag_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updated(spark, sf_dir, ())


@query(_FLAGGED_SQL)
def flag_update_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _updated(spark, sf_dir, ("o_orderstatus",))


@query(_FLAGGED_SQL)
def flag_update_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flag partitions its table, so flagged rows move."""
    return _updated(spark, sf_dir, ("o_orderstatus", "flag"))


@query(
    """
    select o_orderkey, o_custkey, o_totalprice,
           case when o_orderpriority like '1%' or o_orderpriority like '5%' then 'again'
                else 'first' end as load, o_orderpriority
    from orders
    """
)
def sink_replace_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of a catalog table one partition is replaced and one is new."""
    orders = _orders(spark, sf_dir)
    known = ~F.coalesce(F.col("o_orderpriority").startswith("5"), F.lit(False))
    first = orders.where(known).withColumn("load", F.lit("first"))
    name = catalog_table(spark, first, "orders", ("o_orderpriority",))
    some = orders.where(F.col("o_orderpriority").rlike("^[15]"))
    again = some.withColumn("load", F.lit("again"))
    replace_partitions(again, name, scratch(spark, "replaced"))
    return spark.table(name)


@query("select * from part")
def schema_gated_move(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, location = fresh_name("part"), scratch(spark, "part")
    part = table(spark, sf_dir, "part")
    promoted = F.col("p_type").eqNullSafe("PROMO")
    for half in (promoted, ~promoted):
        move(part.where(half), name, location, partitions=["p_brand"])
    return spark.table(name)
