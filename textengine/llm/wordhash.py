"""64-bit hashes of all words, and of runs of words, of a column of texts, in numpy.

Works on the bytes of a whole Arrow column, in slices of bounded size, with no Python step per word.
A word's hash is a polynomial of its bytes (each byte through a table of random values) modulo 2^64,
taken from prefix sums, then mixed; different words agree with a chance of about 2^-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
SLICE = 1 << 18  # bytes of text worked on at once; a longer text is a slice of its own


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    a, b = np.full(n, BASE, np.uint64), np.full(n, inverse, np.uint64)
    a[0] = b[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(a), np.multiply.accumulate(b)


_kept_powers = cache(_powers)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers and its inverse's, n of them at least; those for a usual slice are kept."""
    return _kept_powers(SLICE + 8) if n <= SLICE + 8 else _powers(n)


@cache
def byte_values(lower: bool) -> np.ndarray:
    r = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.int64).astype(np.uint64)
    if lower:
        r[65:91] = r[97:123]
    return r


@cache
def _spaces() -> np.ndarray:
    s = np.zeros(256, bool)
    s[[32, 9, 10, 11, 12, 13]] = True
    return s


def mix(h: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words:
    """Of a slice of texts: data (bytes), start and end of each word in data, doc (its text's number in the slice),
    first (the number of each text's first word, with one more at the end), prefix sums for hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.data, self.offsets = data, offsets
        n = len(data)
        word = ~_spaces()[data] if n else np.zeros(0, bool)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before, after = np.zeros(n, bool), np.zeros(n, bool)
        before[1:], after[:-1] = word[:-1], word[1:]
        self.start = np.flatnonzero(word & (~before | edge[:-1]))
        self.end = np.flatnonzero(word & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        up, self.down = powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(byte_values(lower)[data] * up[:n], out=self.sums[1:])

    def hashes(self, most: int = 0) -> np.ndarray:
        """Of the words, or of their first `most` bytes."""
        end = np.minimum(self.end, self.start + most) if most else self.end
        with np.errstate(over="ignore"):
            return mix((self.sums[end] - self.sums[self.start]) * self.down[self.start] + (end - self.start).astype(np.uint64))


def runs(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of k consecutive items; h's k - 1 last have none."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = out * BASE + h[i : i + n]
    return mix(out)


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and offsets from 0; nulls are empty."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(column: pa.Array, lower: bool = False) -> Iterator[tuple[int, int, Words]]:
    """(from, to, words) over the rows of a string column."""
    data, offsets = column_bytes(column)
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + SLICE, "right")) - 1)
        yield at, to, Words(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], lower)
        at = to
