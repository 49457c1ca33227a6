"""Gradient-boosted trees for a yes/no label in numpy, with monotonic constraints, kept as flat
node arrays so that scoring is a few gathers per level for all rows and trees at once."""
from __future__ import annotations

import numpy as np


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.25,
        bins: int = 64, ridge: float = 1.0, least: float = 1.0) -> dict:
    """``monotone[f]`` is 1 (the score may not fall as f grows), -1 (may not rise) or 0.
    A split that would break its constraint is not taken, and the midpoint of its two values
    bounds all values below it, so the constraint holds for whole trees and their sum."""
    n, m = x.shape
    edges = [_edges(x[:, f], bins) for f in range(m)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    base = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def node(v):
        feature.append(0), threshold.append(np.inf), left.append(len(value)), right.append(len(value)), value.append(v)
        return len(value) - 1

    def leaf(g, h, lo, hi):
        return float(np.clip(-g / (h + ridge), lo, hi))

    def grow(rows, g, h, lo, hi, level):
        gs, hs = g[rows].sum(), h[rows].sum()
        me = node(rate * leaf(gs, hs, lo, hi))
        best = (1e-6, None)
        if level < depth and hs > 2 * least:
            for f in range(m):
                k = len(edges[f])
                if not k:
                    continue
                b = binned[rows, f]
                gl = np.cumsum(np.bincount(b, g[rows], k + 1))[:k]
                hl = np.cumsum(np.bincount(b, h[rows], k + 1))[:k]
                gr, hr = gs - gl, hs - hl
                vl, vr = np.clip(-gl / (hl + ridge), lo, hi), np.clip(-gr / (hr + ridge), lo, hi)
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - gs**2 / (hs + ridge)
                ok = (hl >= least) & (hr >= least) & (monotone[f] * (vr - vl) >= 0)
                gain = np.where(ok, gain, -1.0)
                c = int(np.argmax(gain))
                if gain[c] > best[0]:
                    best = (float(gain[c]), (f, c, float(vl[c]), float(vr[c])))
        if best[1] is None:
            score[rows] += value[me]
            return me
        f, c, vl, vr = best[1]
        mid = (vl + vr) / 2
        low_l, high_l, low_r, high_r = lo, hi, lo, hi
        if monotone[f] > 0:
            high_l, low_r = mid, mid
        elif monotone[f] < 0:
            low_l, high_r = mid, mid
        goes = binned[rows, f] <= c
        feature[me], threshold[me] = f, float(edges[f][c])
        left[me] = grow(rows[goes], g, h, low_l, high_l, level + 1)
        right[me] = grow(rows[~goes], g, h, low_r, high_r, level + 1)
        return me

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        roots.append(grow(np.arange(n), p - y, np.maximum(p * (1 - p), 1e-6), -8.0, 8.0, 0))
    return {"base": base, "depth": depth, "roots": np.array(roots), "feature": np.array(feature),
            "threshold": np.array(threshold), "left": np.array(left), "right": np.array(right), "value": np.array(value)}


def score(model: dict, x: np.ndarray) -> np.ndarray:
    """Probability of the label for each row: all trees are walked together."""
    at = np.broadcast_to(model["roots"], (len(x), len(model["roots"])))
    rows = np.arange(len(x))[:, None]
    for _ in range(model["depth"]):
        goes = x[rows, model["feature"][at]] <= model["threshold"][at]
        at = np.where(goes, model["left"][at], model["right"][at])
    return 1 / (1 + np.exp(-(model["base"] + model["value"][at].sum(axis=1))))
