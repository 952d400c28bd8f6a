"""A packed R-tree over count vectors, with overlap bounds."""

from __future__ import annotations

import numpy as np

#: Fewest and most groups of a vector. A set has about 4 to 8 shingles a group: with many more, any two sets of a
#: size have nearly the same counts, and the bound tells nothing.
FEWEST, MOST = 64, 1 << 16
#: Counts that the vectors of one tree may hold in all; trees of more points use fewer groups.
CELLS = 1 << 22
FAN = 16


def groups_for(size: np.ndarray | int) -> np.ndarray:
    """Groups of the vector of a set of some size: a power of 2."""
    return np.left_shift(1, np.clip(np.ceil(np.log2(np.maximum(size, 1) / 8)).astype(np.int64), 6, 16))


def folded(vectors: list[np.ndarray]) -> np.ndarray:
    """Vectors with one number of groups, by adding up groups whose numbers are equal modulo it."""
    groups = min(map(len, vectors))
    while groups > FEWEST and groups * len(vectors) > CELLS:
        groups //= 2
    return np.stack([v.reshape(-1, groups).sum(axis=0, dtype=np.int32) for v in vectors])


def need(a: np.ndarray, b: np.ndarray | int, percent: int) -> np.ndarray:
    """The least overlap with which sets of sizes a and b reach a Jaccard similarity of percent / 100."""
    return -((-percent * (a + b)) // (100 + percent))


class CountTree:
    """Points are vectors of counts by token group; a node keeps the greatest of each coordinate and its least size.

    Two sets share at most the sum over groups of the smaller count, and a set and any set below a node at most that sum
    with the node's corner. As overlap must reach ``need`` of both sizes, a node whose bound is short of it is left out.
    """

    def __init__(self, counts: np.ndarray, sizes: np.ndarray, percent: int):
        self.percent = percent
        lead = counts.argmax(axis=1)
        order = np.lexsort((*counts.T[:8], lead, sizes))
        self.order, self.counts, self.sizes = order, counts[order], sizes[order]
        #: From the leaves up: corners, least and greatest sizes of the nodes.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        corner, low, high = self.counts, self.sizes, self.sizes
        while len(corner) > FAN:
            at = np.arange(0, len(corner), FAN)
            corner, low, high = np.maximum.reduceat(corner, at), np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            self.levels.append((corner, low, high))

    def _fits(self, vector, size, corner, low, high) -> np.ndarray:
        fair = (100 * low <= 100 * size * 100 // self.percent) & (100 * high >= self.percent * size)
        bound = np.minimum(corner, vector).sum(axis=1)
        return fair & (bound >= need(np.maximum(low, -(-size * self.percent // 100)), size, self.percent))

    def partners(self, vector: np.ndarray, size: int) -> np.ndarray:
        """Places in ``order`` of the points that may be similar to a set."""
        at = np.arange(len(self.levels[-1][0]) if self.levels else len(self.counts))
        for k in range(len(self.levels) - 1, -1, -1):
            corner, low, high = self.levels[k]
            at = at[self._fits(vector, size, corner[at], low[at], high[at])]
            width = len(self.levels[k - 1][0]) if k else len(self.counts)
            at = (at[:, None] * FAN + np.arange(FAN)).ravel()
            at = at[at < width]
        return at[self._fits(vector, size, self.counts[at], self.sizes[at], self.sizes[at])]
