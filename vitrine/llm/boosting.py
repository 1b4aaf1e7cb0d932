"""Gradient-boosted trees in numpy: histogram training on a bounded sample, flat node arrays for scoring."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf points to itself."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Sum of the leaves that the rows of `x` fall into, all rows at once."""
        out, rows = np.full(len(x), self.start), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            for _ in range(self.depth):
                at = np.where(x[rows, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out += self.value[at]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(x)))


@dataclass
class _Nodes:
    feature: list = field(default_factory=list)
    threshold: list = field(default_factory=list)
    left: list = field(default_factory=list)
    right: list = field(default_factory=list)
    value: list = field(default_factory=list)

    def leaf(self, v: float) -> int:
        k = len(self.value)
        for part, x in ((self.feature, 0), (self.threshold, np.inf), (self.left, k), (self.right, k), (self.value, v)):
            part.append(x)
        return k


def train(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.2,
          bins: int = 64, least: int = 10, ridge: float = 1.0) -> Trees:
    """Logistic boosting. `monotone`: per feature -1, 0 or 1, the direction in which the score may move.

    A constrained split must order its children's values, and their midpoint
    bounds everything below each of them, so the sum of the trees is monotone.
    """
    n, m = x.shape
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    code = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], 1)
    p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(p / (1 - p)))
    margin, nodes, roots = np.full(n, start), _Nodes(), []

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = grad[rows], hess[rows]
        sg, sh = g.sum(), h.sum()
        k = nodes.leaf(float(np.clip(-sg / (sh + ridge), low, high)) * rate)
        if level == depth or len(rows) < 2 * least:
            margin[rows] += nodes.value[k]
            return k
        best = (1e-6, None)
        for j in range(m):
            size = len(cuts[j]) + 1
            if size == 1:
                continue
            c = code[rows, j]
            gl, hl, nl = (np.cumsum(np.bincount(c, w, size))[:-1] for w in (g, h, None))
            vl, vr = np.clip(-gl / (hl + ridge), low, high), np.clip(-(sg - gl) / (sh - hl + ridge), low, high)
            gain = gl ** 2 / (hl + ridge) + (sg - gl) ** 2 / (sh - hl + ridge) - sg ** 2 / (sh + ridge)
            ok = (nl >= least) & (len(rows) - nl >= least) & (monotone[j] * (vr - vl) >= 0)
            b = int(np.argmax(np.where(ok, gain, -1)))
            if ok[b] and gain[b] > best[0]:
                best = (gain[b], (j, b, vl[b], vr[b]))
        if best[1] is None:
            margin[rows] += nodes.value[k]
            return k
        j, b, vl, vr = best[1]
        mid, down = (vl + vr) / 2, monotone[j]
        bounds = ((low, high),) * 2 if not down else ((low, mid), (mid, high)) if down > 0 else ((mid, high), (low, mid))
        left = code[rows, j] <= b
        a, z = grow(rows[left], level + 1, *bounds[0]), grow(rows[~left], level + 1, *bounds[1])
        nodes.feature[k], nodes.threshold[k], nodes.left[k], nodes.right[k] = j, cuts[j][b], a, z
        return k

    if 0 < y.sum() < n:
        for _ in range(trees):
            q = 1 / (1 + np.exp(-margin))
            grad, hess = q - y, q * (1 - q)
            roots.append(grow(np.arange(n), 0, -np.inf, np.inf))
    return Trees(*(np.array(v) for v in (nodes.feature or [0], nodes.threshold or [np.inf], nodes.left or [0], nodes.right or [0], nodes.value or [0.0])),
                 np.array(roots, dtype=int), depth, start)
