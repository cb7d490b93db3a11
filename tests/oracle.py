"""Compare a query with its SQL, run by DuckDB over the same files."""

from __future__ import annotations

import math
from collections import Counter
from datetime import date, datetime
from pathlib import Path
from typing import Any

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None. Columns are compared by name, rows in any order."""
    cursor = connection.execute(sql)
    expected_names = [column[0] for column in cursor.description]
    if sorted(df.columns) != sorted(expected_names):
        return f"columns {sorted(df.columns)} instead of {sorted(expected_names)}"
    actual = _rows(df.columns, [tuple(row) for row in df.collect()])
    expected = _rows(expected_names, cursor.fetchall())
    if actual == expected:
        return None
    return (
        f"{sum(actual.values())} rows instead of {sum(expected.values())}; "
        f"only in Spark {list((actual - expected).items())[:3]}, "
        f"only in SQL {list((expected - actual).items())[:3]}"
    )


def _rows(names: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[index]) for index in order) for row in rows)


def _plain(value: Any) -> Any:
    if isinstance(value, float):
        return ("float", "nan" if math.isnan(value) else value)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, datetime | date):
        return value.isoformat()
    return value
