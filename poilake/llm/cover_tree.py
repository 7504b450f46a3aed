"""A cover tree over norm-augmented vectors, for exact searches by inner product."""

from __future__ import annotations

import heapq
from collections.abc import Callable
from typing import NamedTuple

import numpy as np

#: Groups of up to so many rows are not divided: the rows hang below the node above them.
LEAF = 8
#: Shares of the squared norm: below it two points count as one when the tree is built, and
#: what is added to squared radii for rounding.
_SAME, _SLACK = 1e-13, 1e-11
#: Queries whose scores are held at once.
_TOGETHER = 512


class CoverTree(NamedTuple):
    """Nodes in arrays; a node's children follow each other, so do its leaves.

    ``point`` is a node's centre (a row), ``radius`` how far its farthest row is. Below a node
    are the nodes from ``child_from`` to ``child_to`` and the rows ``order[row_from:row_to]``.
    """

    point: np.ndarray
    radius: np.ndarray
    child_from: np.ndarray
    child_to: np.ndarray
    row_from: np.ndarray
    row_to: np.ndarray
    order: np.ndarray


def build(vectors: np.ndarray) -> CoverTree:
    """The tree of the rows of a float matrix of integers.

    A coordinate is added that gives all rows the largest norm; a query has 0 there. Inner
    products stay what they are, and nearer rows then have larger ones. The children of a node
    are more than half its level's radius (a power of two) apart and cover its rows within
    that; every row goes to the nearest of them.
    """
    squares = np.einsum("ij,ij->i", vectors, vectors)
    top = float(squares.max(initial=0.0))
    extra = np.sqrt(np.maximum(top - squares, 0.0))

    point, radius, child_from, child_to, row_from, row_to = [0], [0.0], [0], [0], [0], [0]
    order: list[np.ndarray] = []
    filled = 0

    def hang(node: int, rows: np.ndarray) -> None:
        nonlocal filled
        order.append(rows)
        row_from[node], row_to[node] = filled, filled + len(rows)
        filled += len(rows)

    todo = [(0, np.arange(len(vectors)))] if len(vectors) else []
    while todo:
        node, rows = todo.pop()
        center = point[node]
        here, extras = vectors[rows], extra[rows]

        def away(center: int) -> np.ndarray:
            """Squared distances of the node's rows; all rows have the same norm."""
            return np.maximum(2 * top - 2 * (here @ vectors[center] + extras * extra[center]), 0.0)

        nearest = away(center)
        far = float(nearest.max())
        radius[node] = float(np.sqrt(far + _SLACK * top))
        if len(rows) <= LEAF or far <= _SAME * top:
            hang(node, rows)
            continue
        cover = 4.0 ** (np.ceil(np.log2(far) / 2) - 1)  # the square of half the level's radius, below ``far``
        centers, whose = [center], np.zeros(len(rows), dtype=np.int64)
        while nearest.max() > cover:
            centers.append(int(rows[nearest.argmax()]))
            other = away(centers[-1])
            closer = other < nearest
            whose[closer] = len(centers) - 1
            nearest = np.minimum(nearest, other)
            nearest[closer & (rows == centers[-1])] = 0.0
        groups = np.split(np.argsort(whose, kind="stable"), np.cumsum(np.bincount(whose, minlength=len(centers)))[:-1])
        child_from[node] = len(point)
        for c, group in zip(centers, groups):
            if len(group) > LEAF:
                todo.append((len(point), rows[group]))
                for column, value in ((point, c), (radius, 0.0), (child_from, 0), (child_to, 0), (row_from, 0), (row_to, 0)):
                    column.append(value)
        child_to[node] = len(point)
        hang(node, rows[np.concatenate([g for g in groups if len(g) <= LEAF] or [np.empty(0, dtype=np.int64)])])
    return CoverTree(
        np.array(point), np.array(radius), np.array(child_from), np.array(child_to),
        np.array(row_from), np.array(row_to),
        np.concatenate([*order, np.empty(0, dtype=np.int64)]),
    )


class Best:
    """The ``k`` best (score, id): higher scores first, ties by smaller id."""

    def __init__(self, k: int):
        self.k = k
        self.scores = np.empty(0, dtype=np.int64)
        self.ids = np.empty(0, dtype=np.int64)

    @property
    def least(self) -> float:
        """A lower score can't be among the best any more."""
        return float(self.scores[-1]) if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        if len(scores) > self.k:
            keep = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[keep], ids[keep]
        scores = np.concatenate([self.scores, scores.astype(np.int64)])
        ids = np.concatenate([self.ids, ids])
        first = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[first], ids[first]


class Ask:
    """What one query looks for: the best allowed rows in each of some windows of scores."""

    def __init__(self, k: int, windows: list[tuple[float, float]]):
        self.windows, self.best = windows, [Best(k) for _ in windows]
        self.high = max((high for _, high in windows), default=-np.inf)
        self.refresh()

    def refresh(self) -> None:
        """``low``: rows that score less are not among the best of any window any more."""
        self.low = min((max(low, b.least) for (low, high), b in zip(self.windows, self.best) if low <= high), default=np.inf)

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for (low, high), best in zip(self.windows, self.best):
            fits = (scores >= max(low, best.least)) & (scores <= high)
            if fits.any():
                best.add(scores[fits], ids[fits])
        self.refresh()


def search(
    tree: CoverTree, vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, asks: list[Ask], allowed: Callable[[int, np.ndarray], np.ndarray]
) -> None:
    """Adds what each query asks for; ``allowed`` says which of some rows a query may have.

    Best first: each query opens the node with the highest bound next, skips nodes whose bounds
    lie outside its windows, and ends when its best rows are better than what bounds allow.
    Queries that open a node together share the product with its centres and rows, whose
    scores are exact.
    """
    norms = np.sqrt(np.einsum("ij,ij->i", queries, queries)) * (1 + 1e-9)
    heaps = [[(-np.inf, 0)] for _ in asks]
    active = list(range(len(asks)))
    while active:
        opened: dict[int, list[int]] = {}
        for q in active:
            bound, node = heapq.heappop(heaps[q])
            if -bound >= asks[q].low:
                opened.setdefault(node, []).append(q)
        active = []
        for node, group in opened.items():
            rows = tree.order[tree.row_from[node] : tree.row_to[node]]
            nodes = np.arange(tree.child_from[node], tree.child_to[node])
            leaves, centers = vectors[rows].T, vectors[tree.point[nodes]].T
            for i in range(0, len(group), _TOGETHER):
                some = group[i : i + _TOGETHER]
                high = np.array([asks[q].high for q in some])[:, None]
                scores = queries[some] @ leaves
                fits = (scores >= np.array([asks[q].low for q in some])[:, None]) & (scores <= high)
                for j in np.flatnonzero(fits.any(axis=1)).tolist():
                    at = np.flatnonzero(fits[j])
                    at = at[allowed(some[j], rows[at])]
                    if len(at):
                        asks[some[j]].add(scores[j, at], ids[rows[at]])
                if len(nodes):
                    middle, reach = queries[some] @ centers, norms[some][:, None] * tree.radius[nodes]
                    low = np.array([asks[q].low for q in some])[:, None]
                    near = (middle + reach >= low) & (middle - reach <= high)
                    bounds = np.minimum(middle + reach, high)
                    for j, child in zip(*[x.tolist() for x in np.nonzero(near)]):
                        heapq.heappush(heaps[some[j]], (-bounds[j, child], int(nodes[child])))
            active += [q for q in group if heaps[q]]
