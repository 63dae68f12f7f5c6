"""Vectorised word handling over Arrow text columns.

A word is a maximal run of bytes other than ASCII white space (tab to carriage return, space).
Hashes are 64-bit polynomials over random byte values, finalised by a bijective mixer; they do
not depend on the batch, so equal words (or runs of words) hash alike on every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_P = 0x9E3779B97F4A7C15
_Q = 0xD6E8FEB86659FD93
_U = np.uint64
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.Generator(np.random.PCG64(20240917)).integers(1, 1 << 63, 256, dtype=np.uint64) * _U(2) + _U(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for later calls."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else 2 * len(have))
        have = np.full(size, base, np.uint64)
        have[0] = 1
        _powers[base] = have = np.multiply.accumulate(have)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser, a bijection on 64 bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Rolling:
    """Hashes of any range of a sequence, from one prefix sum."""

    def __init__(self, values: np.ndarray, base: int):
        n = len(values)
        self.inverse = powers(pow(base, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * powers(base, n), out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start])


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and the offsets of its rows; a null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = col.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8)[offsets[0] : offsets[-1]] if buffers[2] is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def slices(offsets: np.ndarray, most: int = 1 << 20):
    """Ranges of rows of about ``most`` bytes; a longer row comes alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, "right")) - 1)
        yield a, b
        a = b


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


class Words:
    """The words of some rows: byte bounds, hashes, and each row's range of words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, hashes: bool = True):
        self.data, self.offsets = data, offsets
        word = ~_SPACE[data]
        first, last = word.copy(), word.copy()
        first[1:] &= ~word[:-1]
        last[:-1] &= ~word[1:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        first[inner] = word[inner]
        last[inner - 1] = word[inner - 1]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.rows = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.rows)
        if hashes:
            self.hash = Rolling(_BYTE[data], _P).of(self.start, self.end)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def rolling(self) -> Rolling:
        return Rolling(self.hash, _Q)


def sliding(x: np.ndarray, w: int, op) -> np.ndarray:
    """op over x[i:i+w] for each i up to len(x)-w, by doubling."""
    n = len(x) - w + 1
    if n <= 0:
        return x[:0]
    span, cur = 1, x
    while span * 2 <= w:
        cur = op(cur[:-span], cur[span:])
        span *= 2
    return op(cur[:n], cur[w - span : w - span + n])


def text_rows(batch: pa.RecordBatch, column: str = "text", most: int = 1 << 20):
    """Slices of a batch: (first row, last row + 1, bytes, offsets)."""
    data, offsets = text_bytes(batch.column(column))
    for a, b in slices(offsets, most):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
