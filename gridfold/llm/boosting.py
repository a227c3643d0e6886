"""Gradient-boosted trees for two classes on a bounded sample, and their form as a SQL expression."""

from __future__ import annotations

import numpy as np

Tree = tuple  # (feature, threshold, left, right) or (value,)


def grow(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, penalty: float = 1.0, least: int = 4) -> Tree:
    """One regression tree on gradients g and curvatures h, by exact greedy splits."""
    best = (1e-6, -1, 0.0)
    whole = g.sum() ** 2 / (h.sum() + penalty)
    if depth and len(g) >= 2 * least:
        for j in range(x.shape[1]):
            order = np.argsort(x[:, j], kind="stable")
            v, gs, hs = x[order, j], np.cumsum(g[order]), np.cumsum(h[order])
            at = np.flatnonzero(v[1:] > v[:-1])
            at = at[(at + 1 >= least) & (at + 1 <= len(v) - least)]
            if not len(at):
                continue
            gain = gs[at] ** 2 / (hs[at] + penalty) + (gs[-1] - gs[at]) ** 2 / (hs[-1] - hs[at] + penalty) - whole
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (float(gain[k]), j, float((v[at[k]] + v[at[k] + 1]) / 2))
    if best[1] < 0:
        return (float(-g.sum() / (h.sum() + penalty)),)
    left = x[:, best[1]] < best[2]
    return (best[1], best[2], grow(x[left], g[left], h[left], depth - 1), grow(x[~left], g[~left], h[~left], depth - 1))


def apply(tree: Tree, x: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(x), tree[0])
    left = x[:, tree[0]] < tree[1]
    return np.where(left, apply(tree[2], x), apply(tree[3], x))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 4, rate: float = 0.4) -> list[Tree]:
    margin, out = np.zeros(len(y)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(x, p - y, p * (1 - p), depth)
        margin += rate * apply(tree, x)
        out.append(_scaled(tree, rate))
    return out


def _scaled(tree: Tree, rate: float) -> Tree:
    return (tree[0] * rate,) if len(tree) == 1 else (tree[0], tree[1], _scaled(tree[2], rate), _scaled(tree[3], rate))


def margin(trees: list[Tree], x: np.ndarray) -> np.ndarray:
    return sum((apply(t, x) for t in trees), np.zeros(len(x)))


def sql(tree: Tree, features: list[str]) -> str:
    if len(tree) == 1:
        return f"{tree[0]!r}D"
    return f"IF({features[tree[0]]} < {tree[1]!r}D, {sql(tree[2], features)}, {sql(tree[3], features)})"


def threshold(score: np.ndarray, y: np.ndarray, precision: float, margin_least: float = 0.0) -> float:
    """The least score at or above which held-out rows reach the precision."""
    order = np.argsort(-score, kind="stable")
    hit = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    good = np.flatnonzero(hit >= precision)
    return max(margin_least, float(score[order][good[-1]])) if len(good) else float("inf")
