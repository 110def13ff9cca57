"""Polynomial hashes of all windows of a byte string at once.

Bytes are mapped to random odd words; a window's hash is the difference of two prefix sums, scaled back to its start, and mixed.
"""

from __future__ import annotations

import numpy as np

#: Longest byte string that is hashed at once.
PIECE = 1 << 18
_BASE = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int) -> np.ndarray:
    out = np.full(PIECE + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)
POWER, INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def prefix(data: np.ndarray) -> np.ndarray:
    """Prefix sums of at most ``PIECE`` bytes, one longer than ``data``."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * POWER[: len(data)], out=out[1:])
    return out


def between(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of ``[start, end)``."""
    return mix((sums[end] - sums[start]) * INVERSE[start])


def windows(sums: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` bytes."""
    n = len(sums) - size
    return mix((sums[size:] - sums[:n]) * INVERSE[:n]) if n > 0 else np.zeros(0, np.uint64)


def sliding_min(x: np.ndarray, size: int) -> np.ndarray:
    """Smallest of each ``size`` neighbours, by doubling."""
    k, m = 1, x
    while 2 * k <= size:
        m = np.minimum(m[:-k], m[k:])
        k *= 2
    n = len(x) - size + 1
    return np.minimum(m[:n], m[size - k : size - k + n])
