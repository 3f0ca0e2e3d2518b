"""Vectorised text kernels that run inside tasks, on the buffers of an Arrow string column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once; a longer document is handled alone and whole.
STEP = 1 << 21

_U = np.uint64
_ODD = _U(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# The bytes that separate words, space and 0x09 to 0x0D.
SOLID = np.ones(256, dtype=np.uint8)
SOLID[[32, 9, 10, 11, 12, 13]] = 0
# Bytes of search terms, that is 0-9, A-Z, a-z and all of multi-byte characters.
TERMS = np.zeros(256, dtype=np.uint8)
TERMS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd base modulo 2**64."""
    global _powers
    if len(_powers) < n:
        factors = np.full(max(n, 2 * len(_powers)), _U(0xD1342543DE82EF95), dtype=np.uint64)
        factors[0] = 1
        _powers = np.cumprod(factors, dtype=np.uint64)
    return _powers[:n]


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column and its ``n + 1`` offsets; null counts as empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def steps(offsets: np.ndarray, limit: int = STEP) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each, one row at least."""
    at, rows = 0, len(offsets) - 1
    while at < rows:
        to = int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1
        to = min(max(to, at + 1), rows)
        yield at, to
        at = to


class Words:
    """Words of consecutive rows: ``hash``, ``row``, byte range ``start``/``end``, and ``count`` per row.

    Words are runs of bytes of one class, never across rows; class 0 separates.  By default they are runs of
    bytes other than space and 0x09-0x0D, and A-Z are lower-cased.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, classes: np.ndarray = SOLID, fold: bool = True) -> None:
        begin = int(offsets[0])
        text = data[begin:int(offsets[-1])]
        text = _LOWER[text] if fold else text
        bounds = offsets - begin
        kind = classes[text]
        solid = kind > 0
        change = kind[1:] != kind[:-1]
        first = solid.copy()
        first[1:] &= change
        last = solid.copy()
        last[:-1] &= change
        heads = bounds[:-1][bounds[:-1] < bounds[1:]]
        first[heads] = solid[heads]
        tails = heads[1:] - 1
        last[tails] = solid[tails]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.row = np.searchsorted(bounds, self.start, "right") - 1
        self.count = np.bincount(self.row, minlength=len(offsets) - 1)
        self.text = text
        if len(self.start):
            length = self.end - self.start
            edge = np.cumsum(length) - length
            inside = np.flatnonzero(solid)
            place = np.arange(len(inside)) - np.repeat(edge, length)
            terms = (text[inside].astype(np.uint64) + _U(1)) * powers(int(length.max()))[place]
            self.hash = mixed(np.add.reduceat(terms, edge) + length.astype(np.uint64) * _ODD)
        else:
            self.hash = np.zeros(0, np.uint64)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words and their rows; a row with fewer words gives its whole sequence as one."""
    h, row, n = words.hash, words.row, len(words.hash)
    scale = powers(k + 1)
    if n >= k:
        total = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            total += h[i:n - k + 1 + i] * scale[i]
        whole = row[:n - k + 1] == row[k - 1:]
        long_hash, long_row = mixed(total[whole]), row[:n - k + 1][whole]
    else:
        long_hash, long_row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((words.count > 0) & (words.count < k))
    if not len(short):
        return long_hash, long_row
    at = np.cumsum(words.count) - words.count
    few = np.zeros(len(short), np.uint64)
    for i in range(k - 1):
        there = words.count[short] > i
        few[there] += h[at[short[there]] + i] * scale[i]
    few = mixed(few ^ (words.count[short].astype(np.uint64) * _ODD))
    return np.concatenate([long_hash, few]), np.concatenate([long_row, short])


_inverses = np.ones(1, dtype=np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    """Inverses of ``powers(n)`` modulo 2**64."""
    global _inverses
    if len(_inverses) < n:
        factors = np.full(max(n, 2 * len(_inverses)), _U(pow(0xD1342543DE82EF95, -1, 1 << 64)), dtype=np.uint64)
        factors[0] = 1
        _inverses = np.cumprod(factors, dtype=np.uint64)
    return _inverses[:n]


def sliding_minimum(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each run of ``w`` values."""
    size = 1
    while 2 * size <= w:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    rest = w - size
    return np.minimum(x[:-rest], x[rest:]) if rest else x
