"""Vectorised words and shingles over the UTF-8 bytes of an Arrow string column.

Nothing here loops over words in Python. Words are byte runs of a class that
never cuts a multi-byte character; each word gets a 64-bit hash taken from a
prefix-sum polynomial, and shingles mix the hashes of consecutive words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
AS_IS = np.arange(256, dtype=np.uint8)

#: Bytes of words [^\x20\x09-\x0D]+ after A-Z are lower-cased.
NON_SPACE = np.ones(256, dtype=bool)
NON_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after A-Z are lower-cased.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_POSITION = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: list[np.ndarray] = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on uint64, into a new array."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, U64(base), dtype=np.uint64)
            steps[0] = 1
            _powers[k] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    n = len(column)
    if not n or column.buffers()[1] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], dtype=wide)[column.offset : column.offset + n + 1].astype(np.int64)
    body = column.buffers()[2]
    data = np.frombuffer(body, dtype=np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


@dataclass
class Words:
    """Words of rows first..last-1 of a column, as bytes of lowered; word w of row r has first_word[r - first] <= w < first_word[r - first + 1]."""

    first: int
    last: int
    lowered: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first_word: np.ndarray

    def text(self, a: int, b: int) -> list[bytes]:
        """Words a..b-1 as lower-cased bytes."""
        return [self.lowered[i:j].tobytes() for i, j in zip(self.start[a:b], self.end[a:b])]


def words(column: pa.Array, kind: np.ndarray, chunk: int = CHUNK_BYTES, case: np.ndarray = LOWER) -> Iterator[Words]:
    """Words of whole texts, for runs of rows of about chunk bytes (one row at least); bytes are mapped by case first."""
    data, offsets = string_bytes(column)
    n, a = len(offsets) - 1, 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + chunk, side="right")) - 1)
        low = case[data[offsets[a] : offsets[b]]]
        at = offsets[a : b + 1] - offsets[a]
        size = len(low)
        inside = kind[low]
        cut = np.zeros(size + 1, dtype=bool)
        cut[at] = True
        start = inside.copy()
        start[1:] &= ~inside[:-1] | cut[1:-1]
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | cut[1:-1]
        start, end = np.flatnonzero(start), np.flatnonzero(stop) + 1
        power, inverse = _tables(size + 1)
        total = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[low] * power[:size], out=total[1:])
        hashed = mix((total[end] - total[start]) * inverse[start])
        yield Words(a, b, low, start, end, hashed, np.searchsorted(start, at))
        a = b


def shingles(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of each row, ascending, and the rows' offsets.

    A row of fewer words, but not none, has its whole sequence as one shingle.
    """
    n, rows = len(w.hash), len(w.first_word) - 1
    counts = np.diff(w.first_word)
    row = np.repeat(np.arange(rows), counts)
    full = n - size + 1
    if full > 0:
        h = w.hash[:full] * _POSITION[0]
        for k in range(1, size):
            h += w.hash[k : k + full] * _POSITION[k]
        keep = row[:full] == row[size - 1 :]
        h, of = mix(h[keep]), row[:full][keep]
    else:
        h, of = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        own = np.zeros(len(short), dtype=np.uint64)
        for k in range(size - 1):
            has = counts[short] > k
            own[has] += w.hash[w.first_word[:-1][short[has]] + k] * _POSITION[k]
        h, of = np.concatenate([h, mix(own ^ counts[short].astype(np.uint64))]), np.concatenate([of, short])
    order = np.lexsort((h, of))
    h, of = h[order], of[order]
    if len(h):
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (of[1:] != of[:-1])
        h, of = h[new], of[new]
    return h, np.searchsorted(of, np.arange(rows + 1))


def list_of_longs(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values.view(np.int64)))
