"""Vectorised text helpers on NumPy arrays, used inside Spark tasks.

All hashes are 64-bit.  A stretch of units (bytes or words) is hashed as
``sum(value[i] * B^(i - start)) mod 2^64`` from prefix sums, so the hash of
any stretch costs O(1); unit values are randomised and results are mixed.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
TOP = U(0xFFFFFFFFFFFFFFFF)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))

_powers: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``B^i`` and ``B^-i`` for ``i < n``; kept by the worker and grown on demand."""
    if len(_powers.get("up", ())) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        for name, base in (("up", BASE), ("down", INVERSE)):
            a = np.full(size, base, dtype=U)
            a[0] = 1
            _powers[name] = np.multiply.accumulate(a)
    return _powers["up"][:n], _powers["down"][:n]


def prefix_hash(values: np.ndarray) -> np.ndarray:
    """``n + 1`` prefix sums for ``stretch_hash``."""
    out = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * powers(len(values))[0], out=out[1:])
    return out


def stretch_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed hash of the units ``start <= i < end`` of each stretch (with its length)."""
    raw = (prefix[end] - prefix[start]) * powers(len(prefix))[1][start]
    return mix(raw + (end - start).astype(U) * U(0xD6E8FEB86659FD93))


def is_space(data: np.ndarray) -> np.ndarray:
    """Bytes outside words: ``[\\x20\\x09-\\x0D]``."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word of a buffer of documents; ``bounds`` are the
    offsets of the documents (``n + 1``), and no word crosses one."""
    inside = ~is_space(data)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cuts = bounds[(bounds > 0) & (bounds < len(data))]
    starts[cuts] |= inside[cuts]
    ends[cuts - 1] |= inside[cuts - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; every other byte as it is."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return stretch_hash(prefix_hash(BYTE_VALUES[data]), starts, ends)


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and ``n + 1`` offsets of an Arrow string column (null: empty)."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8) if column.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, size: int):
    """Row ranges ``(first, last)`` of about ``size`` bytes each; a longer text has its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last
