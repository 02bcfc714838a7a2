"""Word and shingle hashes of whole texts, a batch at a time in numpy."""

from __future__ import annotations

import numpy as np
import pandas as pd

U = np.uint64
# Odd multiplier of the polynomial hash over bytes, and its inverse mod 2^64.
BASE = 0x9DDFEA08EB382D69
INVERSE = pow(BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


# A random-looking value for each byte; A-Z share those of a-z.
_BYTE = _mixed(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
_BYTE[65:91] = _BYTE[97:123]
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base), np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of one text, A-Z taken as a-z, in order.

    The hash of a word is a difference of prefix sums of byte value times a
    power, brought back to the word's start by the inverse power.
    """
    b = np.frombuffer(text, np.uint8)
    inside = ~_IS_SPACE[b]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, stop = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * _power_table(len(b)), out=sums[1:])
    return _mixed((sums[stop] - sums[start]) * _inverse_table(len(b))[start] + (stop - start).astype(np.uint64))


_tables: dict[int, np.ndarray] = {}


def _table(base: int, n: int) -> np.ndarray:
    have = _tables.get(base)
    if have is None or len(have) < n:
        have = _tables[base] = _powers(base, max(n, 1 << 16))
    return have[:n]


def _power_table(n: int) -> np.ndarray:
    return _table(BASE, n)


def _inverse_table(n: int) -> np.ndarray:
    return _table(INVERSE, n)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted distinct hashes of the text's runs of ``words`` words; a shorter
    text is one shingle, a text without words has none."""
    h = word_hashes(text.encode()) if text else np.zeros(0, np.uint64)
    if not len(h):
        return h
    k = min(words, len(h))
    n = len(h) - k + 1
    out = np.full(n, U(k))
    for i in range(k):
        out = _mixed(out * U(BASE) + h[i : i + n])
    return np.unique(out)


def doc_shingles(texts: pd.Series, words: int) -> list[np.ndarray]:
    return [shingle_set(t if isinstance(t, str) else None, words) for t in texts]
