"""All kinds of equality joins, the product, the self join, and joins in SQL.

The fact side is all events, keyed by text: twenty times the user, so that many have
no customer, and some a fraction, which no key has. The other side is all customers,
most without an event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.operators import equi_join
from conform.queries.registry import Query, query, table
from conform.sources import run_sql

_ON = [("user_key", "c_custkey")]
_SAME_SQL = "l.user_key = cast(r.c_custkey as varchar)"

_SIDES_SQL = """
    with l as (select event_id, event_type, value,
                      cast(20 * user_id as varchar) ||
                      case when event_id % 50 = 0 then '.5' else '' end as user_key
               from events),
         r as (select c_custkey, c_name, c_acctbal from customer)
"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    fraction = F.when(F.col("event_id") % 50 == 0, ".5").otherwise("")
    user_key = F.concat((20 * F.col("user_id")).cast("string"), fraction)
    left = table(spark, sf_dir, "events").select(
        "event_id", "event_type", user_key.alias("user_key"), "value"
    )
    return left, table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")


def _register(name: str, how: str, sql_join: str, columns: str = "l.*, r.*") -> Query:
    sql = f"{_SIDES_SQL} select {columns} from l {sql_join} r on {_SAME_SQL}"

    @query(sql, name=name)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        left, right = _sides(spark, sf_dir)
        return equi_join(left, right, _ON, how)

    return run


join_inner = _register("join_inner", "inner", "join")
join_outer = _register("join_outer", "outer", "full join")
join_full = _register("join_full", "full", "full join")
join_fullouter = _register("join_fullouter", "fullouter", "full join")
join_right = _register("join_right", "right", "right join")
join_rightouter = _register("join_rightouter", "rightouter", "right join")
join_left = _register("join_left", "left", "left join")
join_leftouter = _register("join_leftouter", "leftouter", "left join")
join_anti = _register("join_anti", "leftanti", "anti join", "l.*")
join_semi = _register("join_semi", "leftsemi", "semi join", "l.*")
join_cross_cond = _register("join_cross_cond", "cross", "join")


@query(
    _SIDES_SQL
    + f"select r.*, l.* from r left join l on {_SAME_SQL}"
)
def join_left_hot_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, customers = _sides(spark, sf_dir)
    return equi_join(customers, events, [("c_custkey", "user_key")], "left", hot=("right",))


@query(
    """
    select n_name, segment
    from nation cross join (select distinct c_mktsegment as segment from customer) as s
    """
)
def join_cartesian(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = (
        table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("segment")).distinct()
    )
    return table(spark, sf_dir, "nation").select("n_name").crossJoin(segments)


@query(
    """
    select a.c_custkey, a.c_name, b.c_custkey as superior_key, b.c_name as superior_name
    from customer a join customer b on a.c_custkey // 2 = b.c_custkey
    """
)
def join_self(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    staff = customers.withColumn("superior", F.expr("c_custkey div 2"))
    return (
        staff.alias("a")
        .join(customers.alias("b"), F.col("a.superior") == F.col("b.c_custkey"))
        .select(
            "a.c_custkey",
            "a.c_name",
            F.col("b.c_custkey").alias("superior_key"),
            F.col("b.c_name").alias("superior_name"),
        )
    )


_INNER_SQL = """
    select o_orderkey, o_orderstatus, c_name
    from {orders} o inner join {customer} c on o.o_custkey == c.c_custkey
"""

_COMMA_SQL = """
    select l_orderkey, l_linenumber, s_name
    from {lineitem} l, {supplier} s where l.l_suppkey == s.s_suppkey
"""


@query(_INNER_SQL.format(orders="orders", customer="customer"))
def join_sql_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer = (table(spark, sf_dir, name) for name in ("orders", "customer"))
    return run_sql(spark, _INNER_SQL, orders=orders, customer=customer)


@query(_COMMA_SQL.format(lineitem="lineitem", supplier="supplier"))
def join_sql_comma(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, supplier = (table(spark, sf_dir, name) for name in ("lineitem", "supplier"))
    return run_sql(spark, _COMMA_SQL, lineitem=lineitem, supplier=supplier)
