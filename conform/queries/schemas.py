"""Schemas as rows, each with the size of its table, and checked casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.operators import (
    cast_checked,
    cast_counts,
    cast_lost_rows,
    column_names,
    column_names_types,
    column_report,
    common_columns,
    difference_columns,
    not_null_columns,
)
from conform.queries.registry import ORACLE_SQL, query, scratch, table
from conform.sinks import WrittenCast, write_casts
from conform.sources import rows_frame


def _listed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """A row per name, with its position and the number of rows of ``df``."""
    texts = F.array(*(F.lit(name) for name in names))
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.posexplode(texts).alias("position", "entry"), "n_rows"
    )


def _listed_sql(entry: str, source: str, counted: str, condition: str = "true") -> str:
    return f"""
        select cast(row_number() over (order by seq) - 1 as int) as position, {entry} as entry,
               (select count(*) from {counted}) as n_rows
        from (select *, row_number() over () as seq from (describe {source})) as d
        where {condition}
    """


@query(_listed_sql("lower(column_name)", "lineitem", "lineitem"))
def schema_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return _listed(lines, column_names(lines))


_TYPE_SQL = """
    case column_type when 'BIGINT' then 'long' when 'INTEGER' then 'integer'
                     when 'DOUBLE' then 'double' when 'VARCHAR' then 'string'
                     when 'TIMESTAMP' then 'timestamp_ntz' end
"""


@query(_listed_sql(f"lower(column_name) || '-!-' || {_TYPE_SQL}", "orders", "orders"))
def schema_names_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return _listed(orders, column_names_types(orders))


@query(
    """
    select cast(position as int) as position, entry,
           (select count(*) from (select distinct o_orderstatus from orders)) as n_rows
    from (values (0, 'n_orders'), (1, 'source')) as v (position, entry)
    """
)
def schema_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = (
        table(spark, sf_dir, "orders")
        .groupBy("o_orderstatus")
        .agg(F.count(F.lit(1)).alias("n_orders"))
        .withColumn("source", F.lit("orders"))
    )
    return _listed(counts, not_null_columns(counts))


def _without_prefix(df: DataFrame) -> list[str]:
    return [name.split("_", 1)[1] for name in column_names(df)]


_NAME_SQL = "substr(column_name, 3)"
_OTHER_SQL = f"(select {_NAME_SQL} from (describe supplier))"


@query(_listed_sql(_NAME_SQL, "customer", "customer", f"{_NAME_SQL} not in {_OTHER_SQL}"))
def schema_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = (table(spark, sf_dir, name) for name in ("customer", "supplier"))
    names = difference_columns(_without_prefix(customer), _without_prefix(supplier))
    return _listed(customer, names)


@query(_listed_sql(_NAME_SQL, "customer", "customer", f"{_NAME_SQL} in {_OTHER_SQL}"))
def schema_common(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, supplier = (table(spark, sf_dir, name) for name in ("customer", "supplier"))
    names = common_columns(_without_prefix(customer), _without_prefix(supplier))
    return _listed(customer, names)


@query(
    """
    select (select string_agg(chr(10) || '- ' || column_name, '') from (describe part)) as report,
           (select count(*) from part) as n_rows
    """
)
def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return part.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(column_report(column_names(part))).alias("report"), "n_rows"
    )


# Line numbers, some with a letter, some with a fraction, some null.
_MIXED_SQL = """
    select l_orderkey, l_linenumber,
           case when l_returnflag = 'A' then l_linenumber || '.75'
                when l_returnflag = 'N' then l_linenumber || 'N'
                when l_linestatus = 'F' then cast(l_linenumber as varchar) end as number
    from lineitem
"""


def _mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.col("l_linenumber").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "A", F.concat(number, F.lit(".75")))
        .when(F.col("l_returnflag") == "N", F.concat(number, F.lit("N")))
        .when(F.col("l_linestatus") == "F", number)
        .alias("number"),
    )


@query(
    f"""
    select l_orderkey, l_linenumber,
           case when regexp_full_match(number, '[0-9]+') then cast(number as int) end as number
    from ({_MIXED_SQL}) as m
    """,
    name="cast_checked",
)
def checked_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_checked(_mixed(spark, sf_dir), "number", "int")


@query(
    f"""
    select l_orderkey, l_linenumber,
           case when regexp_full_match(number, '[0-9.]+')
                then cast(string_split(number, '.')[1] as int) end as number
    from ({_MIXED_SQL}) as m
    """
)
def cast_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_checked(_mixed(spark, sf_dir), "number", "int", truncate=True)


@query(
    f"select * from ({_MIXED_SQL}) as m where not regexp_full_match(number, '[0-9]+')",
    name="cast_lost_rows",
)
def lost_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_lost_rows(_mixed(spark, sf_dir), "number", "int")


@query(
    f"""
    select count(*) filter (number is null or regexp_full_match(number, '[0-9]+')) as kept,
           count(*) filter (number like '%.%') as changed,
           count(*) filter (number like '%N') as lost
    from ({_MIXED_SQL}) as m
    """,
    name="cast_counts",
)
def counted_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cast_counts(_mixed(spark, sf_dir), "number", "int", truncate=True)


@query("select p_partkey, cast(null as int) as words from part")
def cast_impossible(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select("p_partkey", F.split("p_name", " ").alias("words"))
    return cast_checked(parts, "words", "int")


def _written(spark: SparkSession, sf_dir: str, truncate: bool = False) -> WrittenCast:
    mixed = _mixed(spark, sf_dir)
    return write_casts(mixed, {"number": "int"}, scratch(spark, "casts"), truncate)


@query(ORACLE_SQL["cast_checked"])
def cast_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written(spark, sf_dir).rows


@query(
    f"""
    select l_orderkey, l_linenumber, cast(null as int) as number, 'number' as "column",
           number as value
    from ({_MIXED_SQL}) as m where not regexp_full_match(number, '[0-9]+')
    """
)
def cast_written_lost(spark: SparkSession, sf_dir: str) -> DataFrame:
    lost = _written(spark, sf_dir).lost
    return lost.select("*", F.inline("lost_values")).drop("lost_values")


@query(
    ORACLE_SQL["cast_counts"].replace(" as lost", " as lost, count(*) as written")
)
def cast_written_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts that the job took which wrote the rows."""
    written = _written(spark, sf_dir, truncate=True)
    counts = written.counts["number"]
    row = (counts.kept, counts.changed, counts.lost, written.written)
    return rows_frame(spark, [row], "kept bigint, changed bigint, lost bigint, written bigint")
