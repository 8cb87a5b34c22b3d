"""R-tree over count vectors: which pairs of sets may overlap enough."""

from __future__ import annotations

import numpy as np

FANOUT = 16
PAIRS = 1 << 14


class CountTree:
    """Sets as points: the counts of their members in hashed groups. A box keeps the largest count per group.

    Two sets share at most the sum over groups of the smaller count; a set and a box's sets at most the sum of the
    smaller of the count and the box's maximum. ``classes`` marks sets that need not be compared with one another.
    """

    def __init__(self, points: np.ndarray, sizes: np.ndarray, classes: np.ndarray):
        spread = points.std(axis=0)
        widest = np.argsort(-spread)[:2] if len(points) else [0, 0]
        # Packed by class, then size in slices, then the widest coordinates, so that boxes stay small and of one class.
        slice_ = np.searchsorted(np.cumprod(np.full(64, 1.15)), np.maximum(sizes, 1))
        self.order = np.lexsort((sizes, points[:, widest[1]], points[:, widest[0]], slice_, classes))
        self.points, self.sizes, self.classes = points[self.order], sizes[self.order], classes[self.order]
        self.levels = []
        high, small, large, same = self.points, self.sizes, self.sizes, self.classes
        while len(small) > 1:
            at = np.arange(0, len(small), FANOUT)
            low = np.minimum.reduceat(same, at)
            uniform = np.where(low == np.maximum.reduceat(same, at), low, -1)
            uniform[np.minimum.reduceat(same, at) < 0] = -1
            high, small, large, same = np.maximum.reduceat(high, at, axis=0), np.minimum.reduceat(small, at), np.maximum.reduceat(large, at), uniform
            self.levels.append((high, small, large, same))

    def pairs(self, share: float, left: np.ndarray | None = None, right: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Positions (x, y) of sets of different classes whose Jaccard index may reach ``share``, each pair once.

        With ``left`` and ``right`` (masks), only pairs with one end in each.
        """
        n = len(self.sizes)
        found: list[np.ndarray] = []
        queries = np.arange(n) if left is None else np.flatnonzero(left[self.order])
        allowed = np.ones(n, bool) if right is None else right[self.order]
        stack = [(len(self.levels) - 1, queries, np.zeros(len(queries), np.int64))] if n > 1 and len(queries) else []
        while stack:
            level, q, node = stack.pop()
            if len(q) > PAIRS:
                half = len(q) // 2
                stack += [(level, q[:half], node[:half]), (level, q[half:], node[half:])]
                continue
            high, small, large, same = self.levels[level] if level >= 0 else (self.points, self.sizes, self.sizes, self.classes)
            near = (same[node] < 0) | (same[node] != self.classes[q])
            if level < 0:
                near = (self.classes[node] != self.classes[q]) & allowed[node] & ((q < node) if left is None else (q != node))
            size = self.sizes[q]
            near &= (large[node] >= share * size - 1e-9) & (small[node] * share <= size + 1e-9)
            q, node, size = q[near], node[near], size[near]
            if not len(q):
                continue
            least = np.maximum(small[node], np.ceil(share * size - 1e-9))
            most = np.minimum(self.points[q], high[node]).sum(axis=1, dtype=np.int64)
            fits = most >= share / (1 + share) * (size + least) - 1e-9
            q, node = q[fits], node[fits]
            if level < 0:
                found.append(np.stack([self.order[q], self.order[node]]))
            elif len(q):
                below = n if level == 0 else len(self.levels[level - 1][1])
                child = node[:, None] * FANOUT + np.arange(FANOUT)
                real = child < below
                stack.append((level - 1, np.repeat(q, real.sum(axis=1)), child[real]))
        both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
        return both[0], both[1]
