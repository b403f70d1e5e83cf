"""Hilbert curve indexes of integer points, vectorised (Skilling's transposition, 2004)."""

from __future__ import annotations

import numpy as np


def hilbert_index(points: np.ndarray, bits: int) -> np.ndarray:
    """points (n, dims) of integers in [0, 2**bits) -> (n,) int64 index on the curve; dims * bits is 62 at most."""
    n, dims = points.shape
    if dims * bits > 62:
        raise ValueError("dims * bits must not exceed 62")
    x = [points[:, d].astype(np.int64) for d in range(dims)]
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        p = q - 1
        for d in range(dims):
            flip = (x[d] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[d]) & p)
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            x[d] = x[d] ^ swap
    for d in range(1, dims):
        x[d] = x[d] ^ x[d - 1]
    t = np.zeros(n, np.int64)
    for q in (1 << b for b in range(bits - 1, 0, -1)):
        t = np.where(x[dims - 1] & q, t ^ (q - 1), t)
    x = [v ^ t for v in x]
    out = np.zeros(n, np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            out = out << 1 | (x[d] >> b & 1)
    return out
