"""Seeded 64-bit hashes of many byte strings at once, the same in every process."""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(0x51C5)
#: A random odd number for each byte value, and random odd multipliers.
BYTE = _RNG.integers(0, 2**63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
MUL = _RNG.integers(0, 2**63, 128, np.uint64) * np.uint64(2) + np.uint64(1)
#: Base of the running sums over a block, and its inverse modulo 2 ** 64.
BASE = int(MUL[15])
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of the numbers over all bits."""
    x = (x ^ (x >> np.uint64(31))) * MUL[8]
    x = (x ^ (x >> np.uint64(29))) * MUL[9]
    return x ^ (x >> np.uint64(32))
