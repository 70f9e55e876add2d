"""Gradient-boosted trees in numpy: histogram splits, monotonic constraints, flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class FlatTrees:
    """Every tree's nodes in one set of arrays; a leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row: all rows and trees step down together."""
        if not len(x) or not len(self.roots):
            return np.full(len(x), self.bias)
        node = np.repeat(self.roots[None, :], len(x), axis=0)
        rows = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            go_left = x[rows, self.feature[node]] <= self.threshold[node]
            node = np.where(go_left, self.left[node], self.right[node])
        return self.bias + self.value[node].sum(axis=1)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def constant(share: float) -> FlatTrees:
    none = np.zeros(0, np.int64)
    return FlatTrees(none, np.zeros(0), none, none, np.zeros(0), none, 0, float(np.log(share / (1 - share))))


def fit_trees(x: np.ndarray, y: np.ndarray, monotonic: dict[int, int] | None = None, n_trees: int = 60, depth: int = 3,
              rate: float = 0.2, bins: int = 64, least_rows: int = 20, ridge: float = 1.0) -> FlatTrees:
    """Logistic boosting. ``monotonic`` maps a feature to +1 (may only raise) or -1 (only lower)."""
    monotonic = monotonic or {}
    share = (y.sum() + 0.5) / (len(y) + 1)
    if not len(y) or y.min() == y.max():
        return constant(share)
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    codes = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    bias = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    raw = np.full(len(y), bias)

    def leaf(v: float) -> int:
        at = len(feature)
        feature.append(0), threshold.append(0.0), left.append(at), right.append(at), value.append(v)
        return at

    def best_split(rows, g, h, low, high):
        best = None
        total_g, total_h = g[rows].sum(), h[rows].sum()
        at_rest = total_g ** 2 / (total_h + ridge)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            c = codes[rows, f]
            sums = [np.bincount(c, weights=w, minlength=len(e) + 1).cumsum()[:-1] for w in (g[rows], h[rows], np.ones(len(rows)))]
            lg, lh, ln = sums
            rg, rh, rn = total_g - lg, total_h - lh, len(rows) - ln
            lv, rv = np.clip(-lg / (lh + ridge), low, high), np.clip(-rg / (rh + ridge), low, high)
            gain = lg ** 2 / (lh + ridge) + rg ** 2 / (rh + ridge) - at_rest
            sound = (ln >= least_rows) & (rn >= least_rows)
            if f in monotonic:
                sound &= (rv - lv) * monotonic[f] >= 0
            if sound.any():
                k = int(np.where(sound, gain, -np.inf).argmax())
                if gain[k] > 1e-6 and (best is None or gain[k] > best[0]):
                    best = (gain[k], f, k, lv[k], rv[k])
        return best

    def grow(rows, g, h, level, low, high) -> int:
        split = best_split(rows, g, h, low, high) if level < depth and len(rows) >= 2 * least_rows else None
        if split is None:
            v = rate * float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), low, high))
            raw[rows] += v
            return leaf(v)
        _, f, k, lv, rv = split
        at = leaf(0.0)
        feature[at], threshold[at] = f, float(edges[f][k])
        # Children of a constrained feature stay on their side of the middle.
        middle = (lv + rv) / 2
        side = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}.get(monotonic.get(f, 0), ((low, high), (low, high)))
        mask = codes[rows, f] <= k
        left[at] = grow(rows[mask], g, h, level + 1, *side[0])
        right[at] = grow(rows[~mask], g, h, level + 1, *side[1])
        return at

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-raw))
        roots.append(grow(np.arange(len(y)), p - y, p * (1 - p), 0, -np.inf, np.inf))
    ints = [np.array(a, np.int64) for a in (feature, left, right, roots)]
    return FlatTrees(ints[0], np.array(threshold), ints[1], ints[2], np.array(value), ints[3], depth, bias)
