"""Vantage-point trees over bit strings under the Hamming distance, in numpy.

A node holds a vantage point and a radius. Points within the radius are inside, the others outside.
By the triangle inequality a query whose distance from the vantage point is ``d`` can have points
within ``r`` of it inside only if ``d - r <= radius``, and outside only if ``d + r > radius``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF_POINTS = 48


def distances(points: np.ndarray, one: np.integer) -> np.ndarray:
    """Hamming distances of unsigned integers from one of them."""
    return np.bitwise_count(points ^ one).astype(np.int16)


def split(points: np.ndarray, rng: np.random.Generator) -> tuple[int, int] | None:
    """Position of a vantage point and the radius that halves the points; None if none parts them.

    Of a few candidates the one whose distances spread most is taken: the fewer points lie near
    the boundary, the fewer queries have to look on both sides.
    """
    best = None
    for candidate in rng.integers(0, len(points), min(5, len(points))).tolist():
        found = distances(points, points[candidate])
        if best is None or found.std() > best[0]:
            best = (found.std(), candidate, found)
    _, vantage, found = best
    if found.min() == found.max():
        return None
    radius = int(np.median(found))
    return vantage, radius if radius < found.max() else radius - 1


@dataclass
class Shards:
    """A shallow tree whose leaves are shards; sent to the tasks, so its size is a parameter."""

    nodes: list[tuple[int, int, int, int]]  # vantage, radius, inside, outside; leaves are negative
    leaves: int

    @staticmethod
    def build(points: np.ndarray, leaves: int, seed: int = 7) -> Shards:
        """Split the shard with the most sample points until there are ``leaves``."""
        rng = np.random.default_rng(seed)
        tree = Shards([], 1)
        found: list[tuple[np.ndarray, int | None, int]] = [(points, None, 0)]
        while len(found) < leaves:
            found.sort(key=lambda f: -len(f[0]))
            at = next((i for i, f in enumerate(found) if len(f[0]) > 1), None)
            if at is None:
                break
            own, parent, side = found.pop(at)
            parts = split(own, rng)
            if parts is None:  # equal distances: this shard stays as it is
                found.append((own[:1], parent, side))
                continue
            vantage, radius = own[parts[0]], parts[1]
            node = len(tree.nodes)
            tree.nodes.append((int(vantage), radius, 0, 0))
            tree._link(parent, side, node)
            inside = distances(own, vantage) <= radius
            found += [(own[inside], node, 2), (own[~inside], node, 3)]
        for leaf, (_, parent, side) in enumerate(found):
            tree._link(parent, side, -1 - leaf)
        tree.leaves = len(found)
        return tree

    def _link(self, parent: int | None, side: int, child: int) -> None:
        if parent is not None:
            node = list(self.nodes[parent])
            node[side] = child
            self.nodes[parent] = tuple(node)

    def home(self, points: np.ndarray) -> np.ndarray:
        """The shard of each point."""
        return self._walk(points, 0)[1]

    def reached(self, points: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of point, shard) for all shards that may hold a point within a distance."""
        return self._walk(points, within)

    def _walk(self, points: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        if not self.nodes or not len(points):
            return np.arange(len(points)), np.zeros(len(points), np.int32)
        indexes, shards = [], []
        waiting = [(0, np.arange(len(points)))]
        while waiting:
            at, own = waiting.pop()
            if at < 0:
                indexes.append(own)
                shards.append(np.full(len(own), -1 - at, np.int32))
                continue
            vantage, radius, inside, outside = self.nodes[at]
            found = distances(points[own], points.dtype.type(vantage))
            sides = ((inside, found - within <= radius), (outside, found + within > radius))
            waiting += [(child, own[there]) for child, there in sides if there.any()]
        order = np.argsort(np.concatenate(indexes), kind="stable")
        return np.concatenate(indexes)[order], np.concatenate(shards)[order]


class Forest:
    """Union-find over positions; the smaller root stays on top."""

    def __init__(self, size: int):
        self.parent = np.arange(size)
        self._flat = True

    def _root(self, at: int) -> int:
        parent = self.parent
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    def join(self, one: int, others: list[int]) -> None:
        """Connect some positions to one."""
        for other in others:
            a, b = self._root(one), self._root(other)
            if a != b:
                self.parent[max(a, b)] = min(a, b)
                self._flat = False

    def roots(self) -> np.ndarray:
        """The root of every position."""
        while not self._flat:
            above = self.parent[self.parent]
            self._flat = np.array_equal(above, self.parent)
            self.parent = above
        return self.parent


def connected(
    keys: np.ndarray,
    points: np.ndarray,
    homes: int,
    key_radius: int,
    within: int,
    homes_ask: bool = True,
) -> np.ndarray:
    """For every position the smallest position that it is connected to.

    Points are linked if their distance is ``within`` at most and one of them is among the first
    ``homes`` positions, the points of the tree; all positions are its queries, or unless
    ``homes_ask`` those behind the points of the tree. Linked points that
    are wanted have keys within ``key_radius``. The tree measures keys until these are all equal,
    and then the points themselves.

    Every query near a vantage point is linked to it on the way. What is connected already is not
    compared again, so a dense group costs little more than its points.
    """
    rng = np.random.default_rng(11)
    forest = Forest(len(points))
    waiting = [(np.arange(homes), np.arange(0 if homes_ask else homes, len(points)))]
    while waiting:
        tree, queries = waiting.pop()
        roots = forest.roots()
        of_tree = roots[tree]
        if len(tree) and (of_tree == of_tree[0]).all():
            queries = queries[roots[queries] != of_tree[0]]
        if not len(tree) or not len(queries):
            continue
        if len(tree) <= LEAF_POINTS:
            _compare(forest, points, tree, queries, within)
            continue
        measured, radius = keys, key_radius
        parts = split(keys[tree], rng)
        if parts is None:
            measured, radius = points, within
            parts = split(points[tree], rng)
        if parts is None:  # equal points, which a caller has once only
            _compare(forest, points, tree[:1], np.union1d(tree, queries), within)
            continue
        vantage, cut = tree[parts[0]], parts[1]
        near = distances(points[queries], points[vantage]) <= within
        forest.join(int(vantage), queries[near & (roots[queries] != roots[vantage])].tolist())
        of_tree = distances(measured[tree], measured[vantage])
        of_queries = distances(measured[queries], measured[vantage])
        waiting.append((tree[of_tree <= cut], queries[of_queries - radius <= cut]))
        waiting.append((tree[of_tree > cut], queries[of_queries + radius > cut]))
    return forest.roots()


def _compare(
    forest: Forest, points: np.ndarray, tree: np.ndarray, queries: np.ndarray, within: int
) -> None:
    """Link the queries of a leaf to its points."""
    step = max(1, 1_000_000 // len(tree))
    for begin in range(0, len(queries), step):
        part = queries[begin : begin + step]
        near = np.bitwise_count(points[part][:, None] ^ points[tree][None, :]) <= within
        near &= part[:, None] != tree[None, :]
        for q, t in zip(*(at.tolist() for at in np.nonzero(near))):
            forest.join(int(tree[t]), [int(part[q])])
