"""Hashes of stretches of bytes, worked out for a whole block of texts at once."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_LETTERS = np.random.Generator(np.random.PCG64(20)).integers(
    1, 1 << 63, 256, dtype=np.uint64
) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def mixed(values: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    return values ^ (values >> np.uint64(32))


def _power(kind: str, factor: int, count: int) -> np.ndarray:
    if len(_powers[kind]) < count:
        factors = np.full(count, np.uint64(factor & (1 << 64) - 1))
        factors[0] = 1
        _powers[kind] = np.multiply.accumulate(factors)
    return _powers[kind][:count]


def sums(data: np.ndarray) -> np.ndarray:
    """Running sums from which the hash of any stretch of the bytes follows."""
    terms = _LETTERS[data]
    terms *= _power("up", _BASE, len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(terms, out=total[1:])
    return total


def stretches(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of stretches, equal for equal bytes wherever they lie."""
    down = _power("down", _INVERSE, len(total))
    return mixed((total[end] - total[start]) * down[start])


def shingles(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The set of word shingles of each text, and whose each is, in rising order.

    A-Z are lower-cased, words lie between blanks; a text with fewer words has one
    shingle of them all, one without words none. Hashes have 64 bits: two different
    shingles of a pair of texts fall together with a chance of their number squared
    over 2^64.
    """
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    if not len(data):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    data = np.where((data >= 65) & (data <= 90), data + 32, data)
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(np.diff(np.concatenate([[True], blank])))
    start, end = edge[0::2], edge[1::2]
    ends = np.cumsum([len(t) + 1 for t in texts])
    owner = np.searchsorted(ends, start, side="right")
    word = stretches(sums(data), start, end)
    factors = mixed(np.arange(1, words + 1, dtype=np.uint64)) | np.uint64(1)
    count = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)[:-1]])
    full = len(word) - words + 1
    if full > 0:
        found = sum(word[i : i + full] * factors[i] for i in range(words))
        inside = owner[:full] == owner[words - 1 :]
        found, whose = mixed(found[inside]), owner[:full][inside]
    else:
        found, whose = np.empty(0, np.uint64), np.empty(0, np.int64)
    few = np.flatnonzero((count > 0) & (count < words))
    short = np.array(
        [
            (word[first[t] : first[t] + count[t]] * factors[: count[t]]).sum() + np.uint64(count[t])
            for t in few
        ],
        dtype=np.uint64,
    )
    found = np.concatenate([found, mixed(short)])
    whose = np.concatenate([whose, few])
    order = np.lexsort((found, whose))
    found, whose = found[order], whose[order]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:] != found[:-1]) | (whose[1:] != whose[:-1])
    return found[new], whose[new]
