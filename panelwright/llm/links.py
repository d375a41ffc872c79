"""What the two similarity joins share: links of one block as counts and a spanning forest, never as pairs."""

from __future__ import annotations

import numpy as np


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Star edges (root, node) that connect what a symmetric boolean matrix connects; fewer edges than nodes."""
    left = linked.any(axis=1)
    out = []
    for root in np.flatnonzero(left).tolist():
        if not left[root]:
            continue
        left[root] = False
        wave = np.array([root])
        while len(wave):
            wave = np.flatnonzero(linked[wave].any(axis=0) & left)
            left[wave] = False
            out += [(root, n) for n in wave.tolist()]
    return out
