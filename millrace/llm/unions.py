"""Connected groups among the rows one task holds."""

from __future__ import annotations

import numpy as np


class Unions:
    """Groups of ``0..n-1``; each group's root is its smallest member."""

    def __init__(self, n: int):
        self.low = np.arange(n)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        """Join ``i[k]`` with ``j[k]`` for every k."""
        while len(i):
            a, b = self._find(i), self._find(j)
            apart = a != b
            if not apart.any():
                return
            i, j, a, b = i[apart], j[apart], a[apart], b[apart]
            np.minimum.at(self.low, np.maximum(a, b), np.minimum(a, b))

    def _find(self, i: np.ndarray) -> np.ndarray:
        at = self.low[i]
        while True:
            up = self.low[at]
            if (up == at).all():
                return at
            at = up

    def roots(self) -> np.ndarray:
        self.low = self._find(np.arange(len(self.low)))
        return self.low
