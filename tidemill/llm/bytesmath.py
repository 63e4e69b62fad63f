"""Hashes over the bytes of Arrow string columns, as numpy array expressions.

A polynomial hash modulo 2^64 over random byte values gives the hash of any
substring from two prefix sums. Two bases give 128 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240229))
BYTE_VALUES = _rng.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


def string_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a string or binary column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    kind = np.int64 if wide else np.int32
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, kind, n + 1, column.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose high bits depend on all bits."""
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    x = x ^ (x >> U(32))
    x = x * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


class Powers:
    """Powers of a base and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                steps = np.full(n, b, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


_POWERS = tuple(Powers(b) for b in BASES)


class Prefix:
    """Prefix sums of one slice of bytes; ``of`` gives hashes of its substrings."""

    def __init__(self, values: np.ndarray, which: int = 0):
        self.powers = _POWERS[which]
        self.powers.reach(len(values) + 1)
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.powers.up[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of each ``[start, end)``; equal bytes give equal hashes wherever they are."""
        return (self.sums[end] - self.sums[start]) * self.powers.down[start]

    def every(self, k: int) -> np.ndarray:
        """Hash of the ``k`` bytes from each position on."""
        n = len(self.sums) - k
        return (self.sums[k:] - self.sums[:n]) * self.powers.down[:n]


def byte_values(data: np.ndarray) -> np.ndarray:
    return BYTE_VALUES[data]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of the ``width`` values from each position on."""
    span = 1
    while 2 * span <= width:
        x = np.minimum(x[: len(x) - span], x[span:])
        span *= 2
    rest = width - span
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def pairs_unique(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(order, first)``: rows sorted by the keys (the first is the major one), and which of them begin a new
    combination of the first two keys."""
    order = np.lexsort(keys[::-1])
    a, b = keys[0][order], keys[1][order]
    first = np.ones(len(order), bool)
    first[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, first
