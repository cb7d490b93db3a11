from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from conform.functions import cipher_key, decrypt, encrypt, hash_key
from conform.operators import new_keys, protect, vault_delta
from conform.operators.protect import VAULT_SCHEMA
from conform.sources import empty_frame, rows_frame
from tests.data import tuples

KEY = "0123456789abcdef"


@pytest.fixture(scope="module")
def ids(spark):
    rows = [("CC", "83120457"), ("CC", "83120457"), ("CE", "7"), (None, "1"), ("", "é")]
    return rows_frame(spark, rows, "kind string, id string")


def test_known_cipher(spark, ids):
    key = cipher_key(spark, KEY)
    text = F.concat("kind", "id")
    values = [row[0] for row in ids.select(encrypt(text, key)).collect()]
    assert values[:2] == ["Wif5dxIrHDcgAarHrn625Q=="] * 2
    assert values[3] == ""


@pytest.mark.parametrize("mode", ["CBC", "GCM"])
@pytest.mark.parametrize("key", [KEY, KEY * 2, bytes(range(24))])
def test_decrypt_undoes_encrypt(spark, ids, mode, key):
    secret = cipher_key(spark, key)
    texts = ids.select("id").unionByName(spark.sql("select repeat('x', 1000) as id"))
    ciphers = texts.select("id", encrypt(F.col("id"), secret, mode).alias("c"))
    plain = ciphers.select("id", decrypt(F.col("c"), secret, mode).alias("p"))
    assert plain.where("id <> p or p is null").count() == 0


def test_random_mode_hides_equal_texts(spark, ids):
    secret = cipher_key(spark, KEY)
    ciphers = ids.limit(2).select(encrypt(F.col("id"), secret, "GCM").alias("c")).collect()
    assert ciphers[0] != ciphers[1]


def test_wrong_keys_and_modes(spark):
    with pytest.raises(ValueError):
        cipher_key(spark, "short")
    key = cipher_key(spark, KEY)
    for function in (encrypt, decrypt):
        with pytest.raises(ValueError):
            function(F.lit("x"), key, "ECB")


def test_the_key_is_in_no_plan(ids, capsys):
    df = protect(ids, [["kind", "id"]], KEY)
    df.collect()
    for mode in ("extended", "formatted", "codegen", "cost"):
        capsys.readouterr()
        df.explain(mode)
        plan = capsys.readouterr().out
        assert KEY not in plan
        assert KEY.encode().hex() not in plan.lower()
    assert not any(KEY in name for name in df.columns)


def test_hash_of_a_null_part_is_null(ids):
    assert [row[0] is None for row in ids.select(hash_key(["kind", "id"])).collect()] == [
        False, False, False, True, False
    ]


def test_one_group(ids):
    df = protect(ids, [["kind", "id"]], KEY)
    assert df.columns == ["kind", "id", "HashValue1", "AESValue1", "AESValue"]
    assert df.where("AESValue1 <> AESValue").count() == 0
    assert df.where("kind is null").select("HashValue1", "AESValue").collect() == [(None, "")]
    dropped = protect(ids, [["kind", "id"]], KEY, drop=True)
    assert dropped.columns == ["HashValue1", "AESValue1", "AESValue"]


def test_several_groups_keep_their_own_columns(spark, ids):
    df = protect(ids, [["kind", "id"], ["id"]], KEY)
    assert df.columns[2:] == ["HashValue1", "HashValue2", "AESValue1", "AESValue2"]
    key = cipher_key(spark, KEY)
    both = df.select(decrypt(F.col("AESValue1"), key), decrypt(F.col("AESValue2"), key))
    assert both.first() == ("CC83120457", "83120457")


def test_without_groups_nothing_changes(ids):
    assert protect(ids, [], KEY) is ids


def test_separator_keeps_keys_apart(spark):
    df = rows_frame(spark, [("1", "23"), ("12", "3")], "a string, b string")
    assert protect(df, [["a", "b"]]).select("HashValue1").distinct().count() == 1
    assert protect(df, [["a", "b"]], sep="|").select("HashValue1").distinct().count() == 2


@pytest.fixture(scope="module")
def data(spark):
    rows = [("a", "1"), ("b", "2"), ("b", "2"), ("c", "3"), (None, "4"), (None, "")]
    return rows_frame(spark, rows, "HashValue1 string, AESValue1 string")


def test_new_keys_equals_the_outer_join_without_partner(spark, data):
    vault = rows_frame(spark, [("a", "1"), ("a", "1"), ("z", "9"), (None, "0")], VAULT_SCHEMA)
    found = new_keys(data, vault)
    assert found.columns == ["hashvalue", "aesvalue"]
    assert tuples(found) == [("b", "2"), ("b", "2"), ("c", "3")]
    outer = vault.join(data, vault.hashvalue == data.HashValue1, "right").where(
        "hashvalue is null and HashValue1 is not null"
    )
    assert tuples(outer.select("HashValue1", "AESValue1")) == tuples(found)
    assert tuples(new_keys(data, vault, dedup=True)) == [("b", "2"), ("c", "3")]


def test_everything_is_new_to_an_empty_vault(spark, data):
    found = new_keys(data, empty_frame(spark, VAULT_SCHEMA))
    assert found.columns == ["hashvalue", "aesvalue"]
    assert found.count() == 4


def test_vault_delta_takes_every_group_once(spark, ids):
    key = cipher_key(spark, KEY)
    vault = ids.where("kind = 'CE'").select(
        hash_key(["kind", "id"]).alias("hashvalue"), F.lit("x").alias("aesvalue")
    )
    delta = vault_delta(ids, [["kind", "id"], ["id"]], key, vault)
    plain = delta.select(decrypt(F.col("aesvalue"), key), F.col("hashvalue"))
    assert [row[0] for row in tuples(plain)] == ["1", "7", "83120457", "CC83120457", "é"]
    assert delta.select(F.sha2(decrypt(F.col("aesvalue"), key), 256) == F.col("hashvalue")
                        ).distinct().collect() == [(True,)]
    grown = vault.unionByName(delta)
    assert vault_delta(ids, [["kind", "id"], ["id"]], key, grown).count() == 0


def test_no_python_runs_on_the_rows(ids, data, capsys):
    for df in (
        protect(ids, [["kind", "id"]], KEY),
        new_keys(data, data.select(F.col("HashValue1").alias("hashvalue"))),
        vault_delta(ids, [["id"]], KEY, data.select(F.col("HashValue1").alias("hashvalue"))),
    ):
        capsys.readouterr()
        df.explain()
        plan = capsys.readouterr().out
        assert "Python" not in plan and "Pandas" not in plan
