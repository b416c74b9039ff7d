"""Space-partition tree over points with missing coordinates.

Nodes split on the coordinate with the widest spread, at its median; where the
node holds points without that coordinate, these are split off first.  The tree
is grown on a bounded sample and holds at most as many leaves as asked for; any
tree gives right answers, because the boxes of the leaves are taken from all
points afterwards.

``Boxes`` bounds the distance ``n / |C| * sum over C of (a_i - b_i)^2`` (``C``:
coordinates present in both points) from below for a point and all points of
a node.  Coordinates every point of the node has count for certain; those only
some of them have are added, nearest first, as long as they lower the mean.
"""

from __future__ import annotations

import heapq

import numpy as np

VALUE, MISSING, LEAF = 0, 1, 2
_SLACK = 1e-9                 # share by which rounding may lift a bound above a distance


class Tree:
    """Nodes in arrays; ``leaf`` numbers the leaves from 0."""

    def __init__(self):
        self.kind, self.dim, self.cut, self.left, self.right, self.leaf = [], [], [], [], [], []
        self.leaves = 0

    def _add(self) -> int:
        for part, value in ((self.kind, LEAF), (self.dim, 0), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.leaf, -1)):
            part.append(value)
        return len(self.kind) - 1

    def packed(self) -> dict:
        return {"kind": np.array(self.kind), "dim": np.array(self.dim), "cut": np.array(self.cut),
                "left": np.array(self.left), "right": np.array(self.right), "leaf": np.array(self.leaf)}


def _best_split(x: np.ndarray) -> tuple[int, int, float] | None:
    """``(kind, dim, cut)`` of a node, or none where its points cannot be told apart."""
    here = ~np.isnan(x)
    share = here.mean(axis=0)
    safe = np.where(here, x, 0.0)
    mean = safe.sum(axis=0) / np.maximum(here.sum(axis=0), 1)
    spread = np.sqrt(np.where(here, (x - mean) ** 2, 0.0).mean(axis=0))
    for d in np.argsort(-spread, kind="stable"):
        if spread[d] <= 0:
            break
        if share[d] < 1:
            return MISSING, int(d), 0.0
        values = np.sort(x[:, d])
        cut = values[(len(values) - 1) // 2]
        if cut == values[-1]:                       # more than half of the points have the greatest value
            cut = values[np.searchsorted(values, cut, "left") - 1]
        return VALUE, int(d), float(cut)
    mixed = np.flatnonzero((share > 0) & (share < 1))
    return (MISSING, int(mixed[0]), 0.0) if len(mixed) else None


def grow(sample: np.ndarray, leaves: int) -> Tree:
    """Tree of at most ``leaves`` leaves; the largest node is split first."""
    tree = Tree()
    root = tree._add()
    heap = [(-len(sample), root, np.arange(len(sample)))]
    done = 0
    while heap and done + len(heap) < leaves:
        _, node, rows = heapq.heappop(heap)
        split = _best_split(sample[rows]) if len(rows) > 1 else None
        if split is None:
            done += 1
            continue
        kind, dim, cut = split
        v = sample[rows, dim]
        goes_left = np.isnan(v) if kind == MISSING else v <= cut
        a, b = tree._add(), tree._add()
        tree.kind[node], tree.dim[node], tree.cut[node], tree.left[node], tree.right[node] = kind, dim, cut, a, b
        heapq.heappush(heap, (-int(goes_left.sum()), a, rows[goes_left]))
        heapq.heappush(heap, (-int((~goes_left).sum()), b, rows[~goes_left]))
    for node, kind in enumerate(tree.kind):
        if kind == LEAF:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
    return tree


def leaf_of(nodes: dict, x: np.ndarray) -> np.ndarray:
    """Leaf of every point.  At a value split a point without the coordinate goes right."""
    at = np.zeros(len(x), np.int64)
    while True:
        open_ = np.flatnonzero(nodes["kind"][at] != LEAF)
        if not len(open_):
            return nodes["leaf"][at]
        node = at[open_]
        v = x[open_, nodes["dim"][node]]
        with np.errstate(invalid="ignore"):
            goes_left = np.where(nodes["kind"][node] == MISSING, np.isnan(v), v <= nodes["cut"][node])
        at[open_] = np.where(goes_left, nodes["left"][node], nodes["right"][node])


class Boxes:
    """Boxes of all nodes from those of the leaves."""

    def __init__(self, nodes: dict, low: np.ndarray, high: np.ndarray, always: np.ndarray, ever: np.ndarray, held: np.ndarray):
        """Per leaf and coordinate: range, whether all and whether any of its points
        have it; ``held``: whether the leaf has points."""
        n, d = len(nodes["kind"]), low.shape[1]
        self.nodes = nodes
        self.low, self.high = np.full((n, d), np.inf), np.full((n, d), -np.inf)
        self.always, self.ever, self.held = np.ones((n, d), bool), np.zeros((n, d), bool), np.zeros(n, bool)
        for node in range(n - 1, -1, -1):            # children have greater numbers than their parent
            if nodes["kind"][node] == LEAF:
                i = nodes["leaf"][node]
                if held[i]:
                    self.low[node], self.high[node], self.always[node], self.ever[node] = low[i], high[i], always[i], ever[i]
                    self.held[node] = True
                continue
            a, b = nodes["left"][node], nodes["right"][node]
            self.low[node], self.high[node] = np.minimum(self.low[a], self.low[b]), np.maximum(self.high[a], self.high[b])
            self.always[node], self.ever[node] = self.always[a] & self.always[b], self.ever[a] | self.ever[b]
            self.held[node] = self.held[a] | self.held[b]

    def bound(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Least distance each point can have to a point of its node; infinite
        where they share no coordinate."""
        d = x.shape[1]
        here = ~np.isnan(x)
        gap = np.maximum(np.maximum(self.low[node] - np.where(here, x, 0.0), np.where(here, x, 0.0) - self.high[node]), 0.0)
        sure = here & self.always[node]
        maybe = here & self.ever[node] & ~self.always[node]
        with np.errstate(invalid="ignore", over="ignore"):
            square = gap * gap
        total = np.where(sure, square, 0.0).sum(axis=1)
        count = sure.sum(axis=1)
        extra = np.sort(np.where(maybe, square, np.inf), axis=1)
        best = np.where(count > 0, total / np.maximum(count, 1), np.inf)
        for i in range(d):
            total = total + extra[:, i]
            best = np.minimum(best, total / (count + i + 1))
        return np.where(self.held[node], best * d * (1 - _SLACK), np.inf)

    def near(self, x: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(point, leaf, bound)`` of every leaf whose bound is within the point's limit, nearest first."""
        points, at = np.arange(len(x)), np.zeros(len(x), np.int64)
        found = []
        while len(points):
            low = self.bound(x[points], at)
            keep = (low <= limit[points]) & (low < np.inf)
            points, at, low = points[keep], at[keep], low[keep]
            is_leaf = self.nodes["kind"][at] == LEAF
            found.append((points[is_leaf], self.nodes["leaf"][at[is_leaf]], low[is_leaf]))
            points, at = points[~is_leaf], at[~is_leaf]
            points, at = np.concatenate([points, points]), np.concatenate([self.nodes["left"][at], self.nodes["right"][at]])
        p, leaf, low = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        order = np.lexsort((leaf, low, p))
        return p[order], leaf[order], low[order]
