"""Column expressions. All of them are built from Spark's own functions."""

from conform.functions.casting import safe_cast
from conform.functions.protection import cipher_key, decrypt, encrypt, hash_key
from conform.functions.values import concat_key, split_pieces, value_map

__all__ = [
    "cipher_key",
    "concat_key",
    "decrypt",
    "encrypt",
    "hash_key",
    "safe_cast",
    "split_pieces",
    "value_map",
]
