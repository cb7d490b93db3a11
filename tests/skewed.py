"""The given tables again, with one key on a third of the rows, and nulls."""

from __future__ import annotations

from pathlib import Path

import duckdb

CHANGES = {
    "orders": """
        case when o_orderkey % 3 = 0 then 7 when o_orderkey % 20 = 1 then null else o_custkey end
            as o_custkey,
        case when o_orderkey % 17 > 0 then o_orderstatus end as o_orderstatus,
        case when o_orderkey % 3 = 1 then '5-LOW' when o_orderkey % 19 > 0 then o_orderpriority end
            as o_orderpriority""",
    "events": """
        case when event_id % 3 = 0 then 7 when event_id % 20 = 1 then null else user_id end
            as user_id""",
    "lineitem": """
        case when l_orderkey % 3 = 0 then 7 when l_orderkey % 20 = 1 then null else l_partkey end
            as l_partkey,
        case when l_orderkey % 3 = 0 then 3 when l_orderkey % 20 = 2 then null else l_suppkey end
            as l_suppkey,
        case when l_orderkey % 11 > 0 then l_returnflag end as l_returnflag""",
    "customer": """
        case when c_custkey % 13 <> 5 then c_name end as c_name,
        case when c_custkey % 9 <> 4 then c_acctbal end as c_acctbal,
        case when c_custkey % 3 = 0 then 'BUILDING' when c_custkey % 20 > 1 then c_mktsegment end
            as c_mktsegment""",
    "part": """
        case when p_partkey % 10 <> 3 then p_name end as p_name,
        case when p_partkey % 7 > 0 then p_type end as p_type""",
    "supplier": "case when s_suppkey % 10 <> 3 then s_name end as s_name",
}


def write_skewed(sf_dir: str, folder: Path) -> str:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        changes = CHANGES.get(path.stem)
        columns = f"* replace ({changes})" if changes else "*"
        connection.execute(
            f"copy (select {columns} from '{path}') to '{folder / path.name}' (format parquet)"
        )
    return str(folder)
