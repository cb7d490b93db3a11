"""Hash and encrypt identifying columns, and find keys a vault has not seen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from conform.functions import cipher_key, concat_key, encrypt
from conform.operators.joins import equi_join

HASH = "hashvalue"
CIPHER = "aesvalue"
VAULT_SCHEMA = f"{HASH} string, {CIPHER} string"


def protect(
    df: DataFrame,
    groups: Sequence[Sequence[str]],
    key: Column | str | bytes | None = None,
    sep: str = "",
    drop: bool = False,
    mode: str = "CBC",
) -> DataFrame:
    """Add ``HashValue1``, ``HashValue2``, … for groups of columns.

    With a ``key`` each group also gets ``AESValue1``, …, and a single group
    its copy ``AESValue``. ``drop`` leaves the plain columns out. Without
    groups the input comes back unchanged.
    """
    if not groups:
        return df
    texts = [concat_key(group, sep) for group in groups]
    added = {f"HashValue{n}": F.sha2(text, 256) for n, text in enumerate(texts, 1)}
    if key is not None:
        key = _as_key(df, key)
        added |= {f"AESValue{n}": encrypt(text, key, mode) for n, text in enumerate(texts, 1)}
    result = df.withColumns(added)
    if key is not None and len(groups) == 1:
        result = result.withColumn("AESValue", F.col("AESValue1"))
    if drop:
        result = result.drop(*{name for group in groups for name in group})
    return result


def new_keys(
    df: DataFrame,
    vault: DataFrame,
    hash_column: str = "HashValue1",
    cipher_column: str = "AESValue1",
    dedup: bool = False,
    bucketed: bool = False,
) -> DataFrame:
    """The hash and cipher of the rows whose hash the vault does not hold.

    Null hashes are left out and repeats kept, unless ``dedup`` is set. Spark splits a
    hot key only where both sides come from a shuffle, and a bucketed vault does not.
    With ``bucketed`` the distinct hashes are looked up there, without moving it, and
    the rows then keep to those not found; this reads ``df`` twice.
    """
    keys = df.select(
        F.col(hash_column).alias(HASH), F.col(cipher_column).alias(CIPHER)
    ).where(F.col(HASH).isNotNull())
    if dedup:
        return _unseen(keys.dropDuplicates([HASH]), vault)
    if bucketed:
        # Dealt by their beginnings, or Spark would keep the vault's partitioning.
        unseen = _unseen(keys.select(HASH).distinct(), vault)
        unseen = unseen.repartition(F.substring(HASH, 1, 8))
        return keys.join(unseen, HASH, "left_semi")
    return equi_join(keys, vault, [(HASH, HASH)], "anti", hot=("left", "right"))


def vault_delta(
    df: DataFrame,
    groups: Sequence[Sequence[str]],
    key: Column | str | bytes,
    vault: DataFrame,
    sep: str = "",
    mode: str = "CBC",
) -> DataFrame:
    """The vault rows to append: each new key of any group, once.

    The table is read once for all groups. Repeats fall together before the
    shuffle, each key is hashed once, and only keys that are new are encrypted.
    """
    texts = F.array(*(concat_key(group, sep) for group in groups))
    plain = df.select(F.explode(texts).alias("plain")).where(F.col("plain").isNotNull())
    keys = plain.distinct().select(F.sha2("plain", 256).alias(HASH), "plain")
    unseen = _unseen(keys, vault)
    return unseen.select(HASH, encrypt(F.col("plain"), _as_key(df, key), mode).alias(CIPHER))


def _unseen(keys: DataFrame, vault: DataFrame) -> DataFrame:
    # No hash comes twice on either side, so there is no hot key to split.
    return keys.join(vault.select(HASH).distinct(), HASH, "left_anti")


def _as_key(df: DataFrame, key: Column | str | bytes) -> Column:
    return key if isinstance(key, Column) else cipher_key(df.sparkSession, key)
