"""Vectorised hashing of words in UTF-8 text with numpy."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Fixed odd multiplier and its inverse modulo 2**64.
_P = 0x9E3779B97F4A7C15
_INV = pow(_P, -1, 1 << 64)
_STEP = 1 << 16


def _powers(base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i for i below _STEP, and base**(i * _STEP)."""

    def row(b: int) -> np.ndarray:
        out = np.full(_STEP, b, dtype=np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    with np.errstate(over="ignore"):
        return row(base), row(pow(base, _STEP, 1 << 64))


_LOW, _HIGH = _powers(_P)
_INV_LOW, _INV_HIGH = _powers(_INV)
_BYTE = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64)
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads all bits."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(30)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def _power(i: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return low[i & (_STEP - 1)] * high[i >> 16]


def raw_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and where each row begins and ends; null rows are empty."""
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data, ends


def slices(ends: np.ndarray, most: int = 1 << 21):
    """Ranges of rows with about most bytes each; a longer row stands alone."""
    i, n = 0, len(ends) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + most, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def word_hashes(data: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, begin and end of every word of data, in order.

    The hash is a polynomial over the bytes of the word, taken from running sums.
    """
    if not len(data):
        z = np.zeros(0, np.int64)
        return z.astype(np.uint64), z, z
    inside = ~SPACE[data]
    edge = np.diff(np.concatenate(([False], inside, [False])).view(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    at = np.arange(len(data), dtype=np.int64)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[LOWER[data] if lower else data] * _power(at, _LOW, _HIGH), out=sums[1:])
        found = (sums[end] - sums[begin]) * _power(begin, _INV_LOW, _INV_HIGH)
        found += (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return mix64(found), begin, end


def padded(data: np.ndarray, ends: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows i to j with a space after each, and where each begins in that."""
    part = data[ends[i] : ends[j]]
    lens = np.diff(ends[i : j + 1])
    starts = (ends[i:j] - ends[i]) + np.arange(j - i)
    out = np.full(len(part) + (j - i), 0x20, dtype=np.uint8)
    out[np.arange(len(part)) + np.repeat(np.arange(j - i), lens)] = part
    return out, starts


def parts(batches, text: int, most: int = 1 << 22):
    """Record batches cut so that the text column has about most bytes in each; a longer row stands alone."""
    for batch in batches:
        _, ends = raw_bytes(batch.column(text))
        for i, j in slices(ends, most):
            yield batch.slice(i, j - i)
