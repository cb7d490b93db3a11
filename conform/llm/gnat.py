"""A geometric near-neighbour access tree over a bounded set of integer points."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Split points of a node, and points from which a child is split further.
DEGREE, LEAF = 8, 12
#: What is added to every bound, in parts of the values compared: far more than the
#: rounding of a few float operations, so that a subtree goes only if it must.
SLACK = 2.0**-44


def kind_for(queries: np.ndarray, points: np.ndarray) -> type:
    """What holds squared distances of whole numbers exactly.

    Floats do while these are below 2^53, long integers below 2^62; beyond that Python's
    integers are used, which have no bound.
    """
    top = max(np.abs(queries).max(initial=0.0), np.abs(points).max(initial=0.0))
    bound = 4.0 * top * top * max(points.shape[1], 1)
    return np.float64 if bound < 2.0**53 else np.int64 if bound < 2.0**62 else object


def squared(queries: np.ndarray, points: np.ndarray, kind: type) -> np.ndarray:
    """Exact squared distances of whole numbers, given as floats: queries by points."""
    if kind is np.float64:
        cross = queries @ points.T
        cross *= -2.0
        cross += (queries * queries).sum(1)[:, None]
        cross += (points * points).sum(1)
        return cross
    left, right = _whole(queries, kind), _whole(points, kind)
    total = np.zeros((len(left), len(right)), kind)
    for at in range(left.shape[1]):
        apart = left[:, at, None] - right[:, at]
        total += apart * apart
    return total


def _whole(values: np.ndarray, kind: type) -> np.ndarray:
    if kind is not object:
        return values.astype(kind)
    whole = np.empty(values.shape, object)
    whole.ravel()[:] = [int(x) for x in values.ravel().tolist()]
    return whole


def _roots(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds below and above the roots."""
    root = np.sqrt(values.astype(np.float64))
    return root * (1 - SLACK), root * (1 + SLACK)


@dataclass(frozen=True)
class _Node:
    """Split points, the subtree of each, and from each split point to each subtree the
    least and greatest distance of any point there, the subtree's own split point included."""

    splits: np.ndarray
    children: list
    low: np.ndarray
    high: np.ndarray


class Gnat:
    """Finds the nearest of a few points; among equally near ones the first.

    ``points`` are whole numbers, given as floats. ``looked`` counts the distances that
    searches worked out, which a test holds against those that all pairs would need.
    """

    def __init__(self, points: np.ndarray):
        self.points = np.asarray(points, np.float64)
        self.looked = 0
        self._root = self._grown(np.arange(len(self.points)))

    def _grown(self, members: np.ndarray):
        """A subtree over some points; a few, or all alike, stay a plain list."""
        if len(members) <= LEAF:
            return members
        held = self.points[members]
        apart = squared(held, held, kind_for(held, held))
        splits = [0]
        nearest = apart[0].copy()
        while len(splits) < DEGREE and nearest.max() > 0:
            splits.append(int(np.argmax(nearest)))
            nearest = np.minimum(nearest, apart[splits[-1]])
        if len(splits) < 2:
            return members
        to_splits = apart[splits]
        home = np.argmin(to_splits, axis=0)
        home[splits] = np.arange(len(splits))
        below, above = _roots(to_splits)
        inside = [np.flatnonzero(home == child) for child in range(len(splits))]
        low = np.array([[row[held].min() for held in inside] for row in below])
        high = np.array([[row[held].max() for held in inside] for row in above])
        children = [
            self._grown(members[held[held != split]])
            for split, held in zip(splits, inside, strict=True)
        ]
        return _Node(members[splits], children, low, high)

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each query the number of the nearest point and the exact squared distance."""
        queries = np.asarray(queries, np.float64)
        found = np.zeros(len(queries), np.int64)
        kind = kind_for(queries, self.points)
        least = squared(queries, self.points[:1], kind)[:, 0]
        self._visit(self._root, queries, np.arange(len(queries)), found, least)
        return found, least

    def _visit(self, node, queries, rows, found, least) -> None:
        if not len(rows):
            return
        numbers = node.splits if isinstance(node, _Node) else node
        if not len(numbers):
            return
        kind = object if least.dtype == object else least.dtype.type
        apart = squared(queries[rows], self.points[numbers], kind)
        self.looked += apart.size
        # Members rise within a list, split points do not: of equal ones the least number.
        near = apart.min(axis=1)
        first = np.where(apart == near[:, None], numbers, len(self.points)).min(axis=1)
        closer = (near < least[rows]) | ((near == least[rows]) & (first < found[rows]))
        found[rows[closer]], least[rows[closer]] = first[closer], near[closer]
        if not isinstance(node, _Node):
            return
        home = np.argmin(apart, axis=1)
        for child in range(len(numbers)):
            self._visit(node.children[child], queries, rows[home == child], found, least)
        below, above = _roots(apart)
        for child in range(len(numbers)):
            reach = _roots(least[rows])[1][:, None]
            # A point at the very distance found must be seen, as its number may be less:
            # a subtree goes only where all of it is strictly farther.
            too_near = below - reach > node.high[:, child] + SLACK * (above + reach)
            too_far = above + reach + SLACK * (above + reach) < node.low[:, child]
            left = ~(too_near | too_far).any(axis=1) & (home != child)
            self._visit(node.children[child], queries, rows[left], found, least)
