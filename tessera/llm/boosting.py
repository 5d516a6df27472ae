"""Histogram gradient-boosted trees for a binary label, in numpy.

Features are cut into quantile bins; a tree grows level by level from
histograms of gradients and curvatures for all nodes, features and bins at
once. A feature may be constrained to act upwards (1) or downwards (-1): no
split against it is taken, and the midpoint of a constrained split bounds
both sides below it. The trees are flattened into node arrays, and scoring
walks all trees of a batch of rows together."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Forest:
    """``feature`` is -1 at a leaf; else values <= ``threshold`` go to ``left``."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        if not len(self.roots):
            return out
        for i in range(0, len(x), 4096):
            part = x[i:i + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            for _ in range(self.depth):
                f = self.feature[node]
                down = np.where(part[rows, np.maximum(f, 0)] <= self.threshold[node], self.left[node], self.right[node])
                node = np.where(f < 0, node, down)
            out[i:i + 4096] += self.value[node].sum(1)
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _cuts(x: np.ndarray) -> np.ndarray:
    """Up to BINS - 1 thresholds, each half-way between two present values."""
    v = np.unique(x)
    if len(v) > BINS:
        v = np.unique(np.quantile(x, np.linspace(0, 1, BINS), method="nearest"))
    return (v[:-1] + v[1:]) / 2


def fit(x: np.ndarray, y: np.ndarray, monotone: tuple[int, ...] | None = None, trees: int = 80, depth: int = 4, rate: float = 0.15,
        least_rows: int = 10, l2: float = 1.0) -> Forest:
    """``x``: rows by features, finite; ``y``: 0 or 1. Without rows every score
    is 0.5; with one class only, all scores are near it."""
    n, k = x.shape
    sign = np.array(monotone if monotone else (0,) * k)
    mean = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(mean / (1 - mean)))
    nodes: list[tuple] = []  # feature, threshold, left, right, value
    roots: list[int] = []
    if n and 0 < y.sum() < n:
        cuts = [_cuts(x[:, j]) for j in range(k)]
        bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
        flat = bins + np.arange(k) * BINS
        margin = np.full(n, base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = y - p, np.maximum(p * (1 - p), 1e-9)
            roots.append(len(nodes))
            nodes.append((-1, 0.0, -1, -1, 0.0))
            at = np.zeros(n, np.int64)  # position of each row's node in ``open_``; -1: in a leaf
            where = np.full(n, roots[-1])
            open_ = [(roots[-1], -np.inf, np.inf)]
            for level in range(depth + 1):
                m = len(open_)
                live = np.flatnonzero(at >= 0)
                cell = (at[live][:, None] * (k * BINS) + flat[live]).ravel()
                hist = [np.bincount(cell, weights=np.repeat(w[live], k), minlength=m * k * BINS).reshape(m, k, BINS) for w in (g, h, np.ones(n))]
                gl, hl, nl = (np.cumsum(a, axis=2) for a in hist)
                total = [a[:, :1, -1:] for a in (gl, hl, nl)]
                gr, hr, nr = total[0] - gl, total[1] - hl, total[2] - nl
                lo, hi = np.array([o[1] for o in open_])[:, None, None], np.array([o[2] for o in open_])[:, None, None]
                vl, vr = np.clip(gl / (hl + l2), lo, hi), np.clip(gr / (hr + l2), lo, hi)
                own = np.clip(total[0] / (total[1] + l2), lo, hi)

                def won(a, b, v):
                    return a * v - 0.5 * (b + l2) * v * v

                gain = won(gl, hl, vl) + won(gr, hr, vr) - won(total[0], total[1], own)
                allowed = (nl >= least_rows) & (nr >= least_rows) & ((vr - vl) * sign[None, :, None] >= 0)
                gain = np.where(allowed, gain, -np.inf).reshape(m, -1)
                best = gain.argmax(1)
                new_at = np.full(n, -1)
                following = []
                for i, (node, low, high) in enumerate(open_):
                    j, b = divmod(int(best[i]), BINS)
                    if level == depth or not gain[i, best[i]] > 1e-6 or b >= len(cuts[j]):
                        nodes[node] = (-1, 0.0, -1, -1, rate * float(own[i, 0, 0]))
                        continue
                    left, right = len(nodes), len(nodes) + 1
                    nodes[node] = (j, float(cuts[j][b]), left, right, 0.0)
                    nodes += [(-1, 0.0, -1, -1, 0.0)] * 2
                    middle = float(vl[i, j, b] + vr[i, j, b]) / 2
                    bounds = {0: ((low, high), (low, high)), 1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle))}[int(sign[j])]
                    mine = np.flatnonzero(at == i)
                    goes_left = bins[mine, j] <= b
                    new_at[mine] = np.where(goes_left, len(following), len(following) + 1)
                    where[mine] = np.where(goes_left, left, right)
                    following += [(left, *bounds[0]), (right, *bounds[1])]
                at, open_ = new_at, following
                if not open_:
                    break
            margin += np.array([nodes[i][4] for i in range(len(nodes))])[where]
    a = list(zip(*nodes)) if nodes else [()] * 5
    return Forest(base, np.array(roots, np.int64), np.array(a[0], np.int64), np.array(a[1], float), np.array(a[2], np.int64),
                  np.array(a[3], np.int64), np.array(a[4], float), depth)
