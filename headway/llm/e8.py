"""The E8 lattice: nearest points and neighbouring points, in numpy."""

from __future__ import annotations

import itertools

import numpy as np


def roots() -> np.ndarray:
    """The 240 shortest lattice vectors: two entries of +-1, or eight of +-1/2
    with an even number of minus signs."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1, -1), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(s) / 2 for s in itertools.product((1, -1), repeat=8) if np.prod(s) > 0]
    return np.array(out)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum: where the sum is odd, the
    worst rounded entry goes to its second nearest integer."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(1) % 2)
    error = x[odd] - near[odd]
    worst = np.abs(error).argmax(1)
    near[odd, worst] += np.where(error[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest lattice point of each row of eight numbers."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    closer = ((x - whole) ** 2).sum(1) <= ((x - half) ** 2).sum(1)
    return np.where(closer[:, None], whole, half)
