"""The E8 lattice: nearest points, neighbouring cells, and random projections onto them."""

from __future__ import annotations

from itertools import combinations, product

import numpy as np


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of even sum."""
    near = np.rint(x)
    odd = near.sum(axis=1) % 2 != 0
    gap = x - near
    worst = np.abs(gap).argmax(axis=1)
    rows = np.flatnonzero(odd)
    near[rows, worst[rows]] += np.where(gap[rows, worst[rows]] >= 0, 1, -1)
    return near


def nearest(x: np.ndarray) -> np.ndarray:
    """Nearest E8 points (rows of 8): D8 or D8 shifted by one half, whichever is closer."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - b) ** 2).sum(axis=1) < ((x - a) ** 2).sum(axis=1)
    return np.where(closer[:, None], b, a)


def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors: two coordinates of +-1, or eight of +-1/2 with an even number of minus signs."""
    out = []
    for i, j in combinations(range(8), 2):
        for a, b in product((1.0, -1.0), repeat=2):
            v = [0.0] * 8
            v[i], v[j] = a, b
            out.append(v)
    out += [list(v) for v in product((0.5, -0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0]
    return np.array(out)


MINIMAL = minimal_vectors()


def cells(x: np.ndarray, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Nearest point of each row and its ``probes`` next nearest minimal neighbours, doubled to integers.

    Shapes (n, 8) and (n, probes, 8). Doubled coordinates are whole numbers.
    """
    home = nearest(x)
    gain = (x - home) @ MINIMAL.T
    best = np.argsort(-gain, axis=1, kind="stable")[:, :probes]
    return np.rint(2 * home).astype(np.int64), np.rint(2 * (home[:, None, :] + MINIMAL[best])).astype(np.int64)


def projections(dim: int, tables: int, blocks: int, scale: float, seed: int) -> np.ndarray:
    """Random projections (tables, blocks, dim, 8) for unit vectors; the same for a seed everywhere."""
    return np.random.Generator(np.random.PCG64([seed, dim])).standard_normal((tables, blocks, dim, 8)) * scale
