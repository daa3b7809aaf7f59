"""Union-find over a small array of nodes inside one task."""

from __future__ import annotations

import numpy as np


class Forest:
    """Components of ``n`` nodes; keeps the edges that joined two of them."""

    def __init__(self, n: int) -> None:
        self.at = np.arange(n, dtype=np.int64)
        self.edges: list[tuple[int, int]] = []

    def join(self, i: np.ndarray, j: np.ndarray) -> None:
        """Add the links i[k] - j[k]. The forest grows by n - 1 edges at most, ever."""
        a, b = self.at[i], self.at[j]
        apart = a != b
        if not apart.any():
            return
        pairs, first = np.unique(
            np.stack([a[apart], b[apart]], axis=1), axis=0, return_index=True)
        i, j = i[apart][first], j[apart][first]
        root: dict[int, int] = {}

        def find(x: int) -> int:
            top = x
            while (up := root.get(top, top)) != top:
                top = up
            while x != top:
                root[x], x = top, root.get(x, x)
            return top

        for (x, y), k, m in zip(pairs.tolist(), i.tolist(), j.tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                self.edges.append((k, m))
        if root:
            moved = np.arange(len(self.at))
            for x in list(root):
                moved[x] = find(x)
            self.at = moved[self.at]
