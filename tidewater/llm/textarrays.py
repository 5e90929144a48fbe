"""Vectorised views of a batch of texts: bytes, words and their hashes as numpy arrays.

Used inside Arrow batches; every function works on whole texts, a bounded number of
bytes at a time (a single longer text makes a slice of its own).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text handled at once.
SLICE_BYTES = 1024 * 1024

_MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix64(np.arange(1, 257, dtype=np.uint64))
_LOWER_CODE = _BYTE_CODE.copy()
_LOWER_CODE[65:91] = _BYTE_CODE[97:123]

#: The bytes that separate words.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


class Texts(NamedTuple):
    """``data``: all bytes; text i is ``data[start[i]:start[i + 1]]``; ``null``: which texts are null."""

    data: np.ndarray
    start: np.ndarray
    null: np.ndarray

    @property
    def n(self) -> int:
        return len(self.start) - 1


class Words(NamedTuple):
    """Words in order: byte range, text index, and ``first[i]``..``first[i + 1]``: the words of text i."""

    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    first: np.ndarray


def slices(column: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of a string array that hold about ``size`` bytes each."""
    offsets = _offsets(column)
    at, n = 0, len(column)
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        to = min(max(to, at + 1), n)
        yield at, to
        at = to


def _offsets(column: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    return np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)


def texts(column: pa.Array) -> Texts:
    if not len(column):
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64), np.zeros(0, bool))
    offsets = _offsets(column)
    null = column.is_null().to_numpy(zero_copy_only=False)
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8)[offsets[0] : offsets[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return Texts(data, offsets - offsets[0], null)


def words(t: Texts) -> Words:
    """Maximal runs of bytes other than space and TAB..CR, never across texts."""
    n = len(t.data)
    inside = ~SPACE[t.data]
    starts, ends = inside.copy(), inside.copy()
    if n:
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cut = t.start[1:-1]
        cut = cut[(cut > 0) & (cut < n)]
        starts[cut] = inside[cut]
        ends[cut - 1] = inside[cut - 1]
    begin = np.flatnonzero(starts)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(begin, t.start)
    return Words(begin, end, np.repeat(np.arange(t.n), np.diff(first)), first)


def range_hasher(data: np.ndarray, lower: bool = False) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function from begins and ends to 64-bit hashes of those byte ranges: prefix sums of a polynomial
    modulo 2**64 over scrambled bytes; ``lower``: A-Z count as a-z."""
    n = len(data)
    power, inverse = (np.full(n + 1, m, dtype=np.uint64) for m in (_MULT, _INV))
    power[0] = inverse[0] = 1
    np.multiply.accumulate(power, out=power)
    np.multiply.accumulate(inverse, out=inverse)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((_LOWER_CODE if lower else _BYTE_CODE)[data] * power[:-1], out=sums[1:])
    return lambda begin, end: mix64((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def range_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    return range_hasher(data, lower)(begin, end)


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of ``values[first[i]:first[i + 1]]`` for every text i."""
    total = np.zeros(len(values) + 1, dtype=np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
