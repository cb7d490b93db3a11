"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores, ``BENCH_RUNS`` the
timed runs after a warm-up, and ``BENCH_QUERIES`` the queries: a comma list, or
``all`` for every registered one.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

from conform.queries import QUERIES

HEADLINES = [
    "scan_delimited_glob",
    "scan_table_where",
    "clean_headers",
    "add_column",
    "case_sql_route",
    "concat_key",
    "split_to_columns",
    "map_partitions",
    "filter_and",
    "filter_array_contains",
    "row_count",
    "distinct_rows",
    "join_inner",
    "join_left",
    "join_right",
    "join_full",
    "join_semi",
    "join_anti",
    "join_self",
    "join_sql_comma",
    "homologate",
    "homologate_multi",
    "cast_checked",
    "cast_lost_rows",
    "cast_counts",
    "hash_key",
    "hash_tuples",
    "encrypt_roundtrip",
    "new_keys",
    "vault_delta",
    "sink_partitioned_parquet",
    "sink_save_table",
    "sink_insert_reordered",
    "sink_dynamic_partition",
    "flag_update",
    "flag_update_partitions",
    "client_product",
    "client_product_ingest",
    "protected_load",
    "audit_rows",
]


def session(cpus: str, folder: str) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("conform-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "4g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/scratch")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINES

    seconds = {}
    with tempfile.TemporaryDirectory(prefix="bench-", ignore_cleanup_errors=True) as folder:
        spark = session(cpus, folder)
        for name in names:
            timed(spark, name, sf_dir)
            seconds[name] = round(
                statistics.median(timed(spark, name, sf_dir) for _ in range(runs)), 4
            )
            print(f"{name}: {seconds[name]}", file=sys.stderr)
        spark.stop()
    print(
        json.dumps(
            {
                "metric": "total of the queries' median times",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
