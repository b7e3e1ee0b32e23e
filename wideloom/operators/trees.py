"""Extremely randomised trees, all grown together, level by level.

A level is two passes over the rows: the range of some features in every open node, and the classes on
either side of one random threshold per feature.  Both are arrays whose size depends on trees, nodes,
features and classes alone.  Rows are never moved or resampled; a row finds its node by walking down
from the root.  Choices follow from tree, node and feature numbers, so a lost task repeats them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wideloom.functions.vectors import matrix_column, width
from wideloom.operators.rowsums import sum_rows

PRIME = 1_000_003
ROWS = 2048  # rows of a batch that walk down all trees at once


def draw(tree: np.ndarray, node: np.ndarray, feature: np.ndarray, turn: int = 0) -> np.ndarray:
    """A number in [0, 1) for each (tree, node, feature)."""
    a = (7919 * (tree + 1) + 104_729 * (node + 1) + 1_299_709 * (feature + 1) + 15_485_863 * (turn + 1)) % PRIME
    for _ in range(3):
        a = (a * a + 12_345 * a + 67_891) % PRIME
    return a / PRIME


@dataclass
class Forest:
    """Nodes in heap order (children of i are 2i + 1 and 2i + 2); feature -1 is a leaf."""

    feature: np.ndarray  # trees, nodes
    threshold: np.ndarray
    shares: np.ndarray  # trees, nodes, classes
    classes: list
    importance: np.ndarray

    def nodes(self, x: np.ndarray) -> np.ndarray:
        """The node that each row ends in, per tree."""
        trees = np.arange(len(self.feature))[None, :]
        at = np.zeros((len(x), len(self.feature)), np.int64)
        while True:
            f = self.feature[trees, at]
            open_ = f >= 0
            if not open_.any():
                return at
            right = np.take_along_axis(x, np.maximum(f, 0), axis=1) > self.threshold[trees, at]
            at = np.where(open_, 2 * at + 1 + right, at)

    def probabilities(self, vec: str | Column) -> Column:
        """Class shares, averaged over the trees."""
        trees = np.arange(len(self.feature))[None, :]
        return matrix_column(lambda x: self.shares[trees, self.nodes(x)].mean(axis=1), vec)


def _places(forest: Forest, nodes: np.ndarray) -> np.ndarray:
    out = np.full(forest.feature.shape, -1)
    out[nodes[:, 0], nodes[:, 1]] = np.arange(len(nodes))
    return out


def _entries(forest: Forest, place: np.ndarray, features: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, number of its open node, entries of the node's features) for every row and tree."""
    spot = place[np.arange(len(place))[None, :], forest.nodes(x)]
    row, tree = np.nonzero(spot >= 0)
    at = spot[row, tree]
    return row, at, x[row[:, None], features[at]]


def candidates(nodes: np.ndarray, p: int, m: int) -> np.ndarray:
    """The ``m`` features that each (tree, node) looks at."""
    return np.argsort(draw(nodes[:, :1], nodes[:, 1:], np.arange(p)[None, :]), axis=1, kind="stable")[:, :m]


def thresholds(nodes: np.ndarray, picked: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    return low + draw(nodes[:, :1], nodes[:, 1:], picked, 1) * (high - low)


def unsplit(trees: int, depth: int, classes: list) -> Forest:
    size = 2 ** (depth + 1) - 1
    return Forest(np.full((trees, size), -1), np.zeros((trees, size)), np.zeros((trees, size, len(classes))), classes, np.zeros(0))


def level_counts(df: DataFrame, vec: str, code: str, forest: Forest, nodes: np.ndarray, features: np.ndarray, cut: np.ndarray,
                 classes: int) -> np.ndarray:
    """Rows per (candidate node, feature, side, class).

    ``nodes`` are (tree, node) pairs, ``features`` and ``cut`` their candidate features and thresholds;
    a row is on side 1 if its entry is above the threshold.
    """
    n, m = features.shape
    place = _places(forest, nodes)

    def part(x, y):
        total = np.zeros(n * m * 2 * classes, np.int64)
        for i in range(0, len(x), ROWS):
            row, at, v = _entries(forest, place, features, x[i:i + ROWS])
            cell = ((at[:, None] * m + np.arange(m)) * 2 + (v > cut[at])) * classes + y[i + row].astype(np.int64)[:, None]
            total += np.bincount(cell.ravel(), minlength=len(total))
        return [total]

    return sum_rows(df, [vec, code], part, numbers=n * m * 2 * classes)[0].reshape(n, m, 2, classes)


def node_ranges(df: DataFrame, vec: str, forest: Forest, nodes: np.ndarray, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest entry of each candidate feature in each node."""
    n, m = features.shape
    place = _places(forest, nodes)

    def part(x):
        lo, hi = np.full((n, m), np.inf), np.full((n, m), -np.inf)
        for i in range(0, len(x), ROWS):
            _, at, v = _entries(forest, place, features, x[i:i + ROWS])
            np.minimum.at(lo, at, v)
            np.maximum.at(hi, at, v)
        return lo, hi

    return tuple(sum_rows(df, [vec], part, lambda a, b: (np.minimum(a[0], b[0]), np.maximum(a[1], b[1])), numbers=2 * n * m))


def _gini(counts: np.ndarray) -> np.ndarray:
    """Rows times impurity, over the last axis."""
    total = counts.sum(-1)
    return total - (counts ** 2).sum(-1) / np.maximum(total, 1)


def extra_trees(df: DataFrame, vec: str, label: str, trees: int = 100, depth: int = 10, features: int | None = None,
                max_classes: int = 1000) -> Forest:
    """Extremely randomised trees on all rows: each node takes the best of sqrt(width) random features at
    one random threshold each; nodes of one class or one value end, and so do those at ``depth``.

    Importances are the impurity decreases by feature, one in all per tree, averaged over the trees.
    Rows without a label or a vector are left out.
    """
    found = df.select(label).where(F.col(label).isNotNull()).distinct().limit(max_classes + 1).collect()
    if len(found) > max_classes:
        raise ValueError(f"more than {max_classes} classes in {label!r}")
    classes = sorted(r[0] for r in found)
    code = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    data = df.where(F.col(label).isNotNull() & F.col(vec).isNotNull()).select(F.col(vec).alias("v"), code.alias("y")).persist()
    p = width(data, "v")
    m = max(1, int(p ** 0.5)) if features is None else features
    k = len(classes)
    forest = unsplit(trees, depth, classes)
    total = sum_rows(data, ["y"], lambda y: [np.bincount(y.astype(np.int64), minlength=k)], numbers=k)[0]
    counts = {(t, 0): total for t in range(trees)}
    gain = np.zeros((trees, p))
    try:
        for level in range(depth + 1):
            for (t, i), c in counts.items():
                forest.shares[t, i] = c / max(c.sum(), 1)
            todo = [(t, i) for (t, i), c in counts.items() if (c > 0).sum() > 1] if level < depth else []
            if not todo:
                break
            nodes = np.array(todo)
            picked = candidates(nodes, p, m)
            cut = thresholds(nodes, picked, *node_ranges(data, "v", forest, nodes, picked))
            sides = level_counts(data, "v", "y", forest, nodes, picked, cut, k)
            whole = np.array([counts[t, i] for t, i in todo])
            drop = _gini(whole)[:, None] - _gini(sides).sum(2)
            drop[(sides.sum(3) == 0).any(2)] = -1.0
            best = drop.argmax(1)
            counts = {}
            for j, (t, i) in enumerate(todo):
                b = best[j]
                if drop[j, b] < 0:
                    continue  # all its features are constant here
                forest.feature[t, i], forest.threshold[t, i] = picked[j, b], cut[j, b]
                gain[t, picked[j, b]] += drop[j, b]
                counts[t, 2 * i + 1], counts[t, 2 * i + 2] = sides[j, b, 0], sides[j, b, 1]
    finally:
        data.unpersist()
    each = gain.sum(axis=1, keepdims=True)
    forest.importance = np.where(each > 0, gain / np.where(each > 0, each, 1), 0).mean(axis=0)
    return forest
