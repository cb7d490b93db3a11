from __future__ import annotations

import pytest

from conform.operators import rules_for, standardise, standardise_any, unmatched_values
from conform.sources import rows_frame
from tests.data import tuples


@pytest.fixture(scope="module")
def rules(spark):
    rows = [
        ("CC", "1", "CLIENTES", "tipo"),
        ("CC", "1", "CLIENTES", "otro"),
        ("CE", "2", "CLIENTES", "tipo"),
        ("XX", "2", "CLIENTES", "tipo"),
        ("PS", "3", "CUENTAS", "tipo"),
        ("ZZ", None, "CLIENTES", "tipo"),
    ]
    schema = "codigo_id string, homologacion string, tabla string, columna string"
    return rows_frame(spark, rows, schema)


@pytest.fixture(scope="module")
def clients(spark):
    rows = [("1", "Ana"), ("2", "Luz"), ("3", "Eva"), (None, "Sol")]
    return rows_frame(spark, rows, "tipo string, nombre string")


def test_rules_of_a_table_and_a_column(rules):
    assert rules_for(rules, "clientes").count() == 4
    assert rules_for(rules, "Clientes", "otro").collect() == [("CC", "1", "CLIENTES")]


def test_inner_drops_and_multiplies(rules, clients):
    df = standardise(clients, rules_for(rules, "clientes"), "tipo")
    assert df.columns == ["nombre", "tipo"]
    assert tuples(df) == [("Ana", "CC"), ("Luz", "CE"), ("Luz", "XX")]


def test_left_keeps_rows_without_a_rule(rules, clients):
    df = standardise(clients, rules_for(rules, "clientes"), "tipo", "left")
    assert tuples(df) == [
        ("Ana", "CC"), ("Eva", None), ("Luz", "CE"), ("Luz", "XX"), ("Sol", None)
    ]
    missing = unmatched_values(clients, rules_for(rules, "clientes"), "tipo")
    assert tuples(missing) == [(None, 1), ("3", 1)]
    with pytest.raises(ValueError):
        standardise(clients, rules, "tipo", "right")


def test_a_number_matches_its_text(spark, rules):
    df = rows_frame(spark, [(1, "Ana"), (9, "Luz")], "tipo int, nombre string")
    assert standardise(df, rules_for(rules, "clientes"), "tipo").collect() == [("Ana", "CC")]


def test_columns_named_like_the_rules(spark, rules):
    df = rows_frame(spark, [("1", "x", "y")], "homologacion string, codigo_id string, tabla string")
    result = standardise(df, rules_for(rules, "clientes"), "homologacion")
    assert result.columns == ["codigo_id", "tabla", "homologacion"]
    assert result.collect() == [("x", "y", "CC")]


def test_any_of_several_values(spark):
    rules = rows_frame(
        spark,
        [("CC", "1", "CC", "1"), ("CE", "2", None, "ext"), ("CE", "2", None, "ext")],
        "code string, a string, b string, c string",
    )
    df = rows_frame(spark, [("1",), ("CC",), ("ext",), ("no",), (None,)], "tipo string")
    once = standardise_any(df, rules, "tipo", ["a", "b", "c"], "code")
    # '1' stands in two columns of one rule and counts once; a rule given twice counts twice
    assert tuples(once) == [("CC",), ("CC",), ("CE",), ("CE",)]
    assert standardise_any(df, rules, "tipo", ["a", "b", "c"], "code", "left").count() == 6


def test_any_is_an_equality_join(spark, capsys):
    rules = rows_frame(spark, [("CC", "1", "CC")], "code string, a string, b string")
    df = spark.range(100).selectExpr("cast(id as string) as tipo")
    capsys.readouterr()
    standardise_any(df, rules, "tipo", ["a", "b"], "code").explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
