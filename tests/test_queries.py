"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

from conform.queries import ORACLE_SQL, QUERIES
from tests.oracle import connect, differences
from tests.skewed import write_skewed

# Queries whose results depend on hot keys and nulls, and that write little.
ON_SKEWED = sorted(
    name
    for name, function in QUERIES.items()
    if function.__module__.rpartition(".")[2]
    in ("filters", "joins", "projections", "protection", "standards")
)


@pytest.fixture(scope="module")
def connection(sf_dir):
    return connect(sf_dir)


@pytest.fixture(scope="module")
def skewed_dir(sf_dir, tmp_path_factory):
    return write_skewed(sf_dir, tmp_path_factory.mktemp("skewed"))


@pytest.fixture(scope="module")
def skewed_connection(skewed_dir):
    return connect(skewed_dir)


def check(spark, sf_dir, connection, name):
    df = QUERIES[name](spark, sf_dir)
    if name in ORACLE_SQL:
        assert differences(df, connection, ORACLE_SQL[name]) is None
    else:
        assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, connection, name):
    check(spark, sf_dir, connection, name)


@pytest.mark.parametrize("name", ON_SKEWED)
def test_query_equals_its_sql_on_skewed_tables(spark, skewed_dir, skewed_connection, name):
    check(spark, skewed_dir, skewed_connection, name)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE_SQL)
