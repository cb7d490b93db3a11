from __future__ import annotations

from types import SimpleNamespace

import pytest

import __spark_entry__ as entry
from conform.queries.registry import fresh_name, query, scratch


def session(**settings: str) -> SimpleNamespace:
    values = {f"spark.{name.replace('_', '.')}": value for name, value in settings.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=values.get))


def test_files_go_to_the_shared_folder():
    shared = session(checkpoint_dir="hdfs://shared/", master="yarn")
    first, second = scratch(shared, "orders"), scratch(shared, "orders")
    assert first.startswith("hdfs://shared/conform-") and first.endswith("/orders")
    assert first != second


def test_only_a_local_session_may_do_without_a_shared_folder():
    assert scratch(session(master="local[4]"), "orders").startswith("/")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch(session(master="spark://host:7077"), "orders")


def test_names():
    assert fresh_name("t") != fresh_name("t")
    with pytest.raises(ValueError):
        query(name="client_product")(lambda spark, sf_dir: None)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[-2:] == ["SCHEMA", "SHA-256"]
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert "client_product" in entry.oracle_sql()
