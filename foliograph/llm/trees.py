"""Small binary classification trees over a bounded table of numbers, fitted on the driver."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: (column, is_greater, threshold): ``x > t`` or ``x <= t``.
Test = tuple[int, bool, float]


@dataclass
class Node:
    share: float  # weighted share of label 1
    column: int = -1
    cut: float = 0.0
    low: "Node | None" = None
    high: "Node | None" = None


def cuts(x: np.ndarray, most: int = 48) -> np.ndarray:
    """Candidate thresholds: midpoints between neighbouring values, thinned by quantile."""
    v = np.unique(x)
    if len(v) > most:
        v = np.unique(np.quantile(v, np.linspace(0, 1, most)))
    return (v[:-1] + v[1:]) / 2


def grow(x: np.ndarray, y: np.ndarray, weight: np.ndarray, depth: int, least: int, columns: np.ndarray | None = None) -> Node:
    """Gini tree of at most ``depth`` levels with ``least`` rows a leaf."""
    total = weight.sum()
    share = float((weight * y).sum() / total) if total else 0.0
    node = Node(share)
    if depth == 0 or len(y) < 2 * least or share in (0.0, 1.0):
        return node
    best = (1e-9, -1, 0.0)
    for c in range(x.shape[1]) if columns is None else columns:
        for t in cuts(x[:, c]):
            high = x[:, c] > t
            k = int(high.sum())
            if k < least or len(y) - k < least:
                continue
            w1 = weight[high].sum()
            p1 = (weight[high] * y[high]).sum() / w1
            p0 = ((weight * y).sum() - p1 * w1) / (total - w1)
            gain = share * (1 - share) - (w1 * p1 * (1 - p1) + (total - w1) * p0 * (1 - p0)) / total
            if gain > best[0]:
                best = (float(gain), int(c), float(t))
    if best[1] < 0:
        return node
    high = x[:, best[1]] > best[2]
    node.column, node.cut = best[1], best[2]
    node.low = grow(x[~high], y[~high], weight[~high], depth - 1, least, columns)
    node.high = grow(x[high], y[high], weight[high], depth - 1, least, columns)
    return node


def share_of(node: Node, x: np.ndarray) -> np.ndarray:
    """Share of label 1 in the leaf of each row."""
    if node.low is None:
        return np.full(len(x), node.share)
    high = x[:, node.column] > node.cut
    out = np.empty(len(x))
    out[high], out[~high] = share_of(node.high, x[high]), share_of(node.low, x[~high])
    return out


def paths(node: Node, tests: tuple[Test, ...] = ()) -> list[tuple[Test, ...]]:
    """The conjunction of tests that leads to each node below the root."""
    if node.low is None:
        return []
    out = []
    for child, greater in ((node.low, False), (node.high, True)):
        to = (*tests, (node.column, greater, node.cut))
        out += [to, *paths(child, to)]
    return out


def holds(x: np.ndarray, tests: tuple[Test, ...]) -> np.ndarray:
    ok = np.ones(len(x), bool)
    for c, greater, t in tests:
        ok &= x[:, c] > t if greater else x[:, c] <= t
    return ok
