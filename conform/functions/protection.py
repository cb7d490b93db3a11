"""Hash and cipher expressions."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from conform.functions.values import concat_key

_BLOCK = 16  # bytes of an AES block, and so of the initial vector
_REST = 2**31 - 1


def hash_key(columns: Sequence[Column | str], sep: str = "") -> Column:
    """SHA-256, in hex, of the concatenated columns; null if any part is null."""
    return F.sha2(concat_key(columns, sep), 256)


def cipher_key(spark: SparkSession, key: str | bytes) -> Column:
    """Wrap a key of 16, 24 or 32 bytes for `encrypt` and `decrypt`.

    The key becomes a one-row subquery, not a literal: a literal would show up
    as text or hex in every printed plan and in the event log.
    """
    raw = key.encode("utf-8") if isinstance(key, str) else key
    if len(raw) not in (16, 24, 32):
        raise ValueError("an AES key has 16, 24 or 32 bytes")
    return spark.createDataFrame(pa.table({"cipher_key": [raw]})).scalar()


def encrypt(column: Column, key: Column, mode: str = "CBC") -> Column:
    """AES in base64; null becomes the empty string.

    ``CBC`` takes the first 16 bytes of the key as its initial vector and
    leaves them out of the result: equal texts give equal ciphers, which can be
    joined but tell that they are equal. ``GCM`` uses a random nonce, kept in
    front of the result, and should be preferred where no join needs the cipher.
    """
    text = column.cast("string").cast("binary")
    if mode == "GCM":
        cipher = F.aes_encrypt(text, key, F.lit("GCM"))
    elif mode == "CBC":
        vector = F.substring(key, 1, _BLOCK)
        with_vector = F.aes_encrypt(text, key, F.lit("CBC"), F.lit("PKCS"), vector)
        cipher = F.substring(with_vector, _BLOCK + 1, _REST)
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return F.coalesce(F.base64(cipher), F.lit(""))


def decrypt(column: Column, key: Column, mode: str = "CBC") -> Column:
    """Undo `encrypt`; the empty string becomes null."""
    cipher = F.unbase64(F.when(column != "", column))
    if mode == "GCM":
        plain = F.aes_decrypt(cipher, key, F.lit("GCM"))
    elif mode == "CBC":
        vector = F.substring(key, 1, _BLOCK)
        plain = F.aes_decrypt(F.concat(vector, cipher), key, F.lit("CBC"), F.lit("PKCS"))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return plain.cast("string")
