"""A robust random cut forest over a stream of vectors, after Guha et al. (2016): trees of random cuts, each over a
time-decayed sample, that score a point by how soon random cuts would part it from the sample.

All trees go down (or up) one level at a time together, in arrays with a row for each tree, so that a point costs a
few array operations for each level and none for each node.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

#: Larger values count as these, so that sums of them stay finite.
LARGEST = 1e100


class Node(NamedTuple):
    """What a tree holds at a node: a leaf (cut None) or a cut of the box low..high; size counts sample points below it."""

    low: np.ndarray
    high: np.ndarray
    size: int
    dim: int = 0
    cut: float | None = None
    left: Node | None = None
    right: Node | None = None


class Tree(NamedTuple):
    """One tree of a forest, to look into."""

    forest: Forest
    number: int

    @property
    def root(self) -> Node | None:
        """The tree's nodes as they are now."""
        return self._node(int(self.forest.root[self.number])) if self.forest.seen else None

    def _node(self, at: int) -> Node:
        f, t = self.forest, self.number
        if at < 0:
            return Node(f.points[t, ~at], f.points[t, ~at], int(f.copies[t, ~at]))
        left, right = (self._node(int(x)) for x in f.kids[t, at])
        return Node(f.low[t, at], f.high[t, at], int(f.sizes[t, at]), int(f.dims[t, at]), float(f.cuts[t, at]), left, right)


class Forest:
    """Trees over samples of size points each, in which a point's chance fades with rate decay a step.

    Equal points share a leaf. A cut's number is its place in the arrays of cuts, a leaf's number the complement of its
    place in the arrays of leaves. Places come from a stack for each tree, of which used counts the leaves' ones in use;
    cuts in use are one fewer. The arrays grow with the points seen up to size places.
    """

    def __init__(self, trees: int = 50, size: int = 128, decay: float = 7.8125e-4, seed: int = 42):
        self.count, self.size, self.decay, self.seen = trees, size, decay, 0
        self.rng = np.random.default_rng(seed)
        self.room = 0

    @property
    def trees(self) -> list[Tree]:
        """The trees, to look into."""
        return [Tree(self, t) for t in range(self.count)]

    def _grow(self, width: int) -> None:
        old, self.room = self.room, min(self.size, max(16, 2 * self.room))
        shapes = {"points": (width,), "low": (width,), "high": (width,), "kids": (2,)} | dict.fromkeys(("copies", "sizes", "dims", "cuts", "widths", "held", "leaves", "free_leaves", "free_cuts"), ())
        floats = {"points", "low", "high", "cuts", "widths", "held"}
        for name, more in shapes.items():
            grown = np.zeros((self.count, self.room, *more), float if name in floats else np.int32)
            if old:
                grown[:, :old] = getattr(self, name)
            setattr(self, name, grown)
        for free in (self.free_leaves, self.free_cuts):
            free[:, old:] = np.arange(old, self.room)
        if not old:
            self.root, self.used = np.zeros(self.count, np.int32), np.zeros(self.count, np.int32)

    def _point(self, point: Sequence[float]) -> np.ndarray:
        return np.clip(np.nan_to_num(np.asarray(point, float)), -LARGEST, LARGEST)

    def _boxes(self, t: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Low and high of nodes, and their sizes."""
        low, high, sizes = self.low[t, at], self.high[t, at], self.sizes[t, at]
        leaf = np.flatnonzero(at < 0)
        if leaf.size:
            u, x = t[leaf], ~at[leaf]
            low[leaf] = high[leaf] = self.points[u, x]
            sizes[leaf] = self.copies[u, x]
        return low, high, sizes

    def score(self, point: Sequence[float]) -> float:
        """The mean of the trees' scores, about 1 for a usual point; 0 before the first update.

        A tree's score is the expected inverse depth at which a random cut parts the point, times the depth of an even
        tree. A NaN counts as 0.
        """
        if not self.seen:
            return 0.0
        point = self._point(point)
        at, depth = self.root.copy(), np.zeros(self.count)
        total, left = np.zeros(self.count), np.ones(self.count)
        t, level = np.flatnonzero(at >= 0), 0
        while t.size:
            n = at[t]
            outside = (np.maximum(self.low[t, n] - point, 0) + np.maximum(point - self.high[t, n], 0)).sum(1)
            parted = outside / (outside + self.widths[t, n])
            level += 1
            total[t] += left[t] * parted / level
            left[t] *= 1 - parted
            depth[t] = level
            n = self.kids[t, n, (point[self.dims[t, n]] > self.cuts[t, n]).astype(int)]
            at[t] = n
            t = t[n >= 0]
        every = np.arange(self.count)
        same = (self.points[every, ~at] == point).all(1)
        total += left / (depth + np.where(same, np.log2(self.copies[every, ~at] + 1), 1))
        return float(total.mean() * np.log2(min(self.seen, self.size) + 1))

    def update(self, point: Sequence[float]) -> None:
        """Offer a point to each tree's sample."""
        point = self._point(point)
        n = min(self.seen, self.size)
        if n == self.room and n < self.size:
            self._grow(len(point))
        self.seen += 1
        chance = np.maximum(self.rng.random(self.count), 1e-300)
        rank = np.log(np.maximum(-np.log(chance), 1e-300)) - self.decay * self.seen
        t = np.arange(self.count)
        place = np.full(self.count, n)
        if n == self.size:
            place = self.held.argmax(1)
            t = np.flatnonzero(self.held[t, place] > rank)
            place = place[t]
            if t.size:
                self._remove(t, self.leaves[t, place])
        if t.size:
            self.leaves[t, place] = self._insert(t, point)
            self.held[t, place] = rank[t]

    def _new_leaf(self, t: np.ndarray, point: np.ndarray) -> np.ndarray:
        leaf = self.free_leaves[t, self.used[t]]
        self.used[t] += 1
        self.points[t, leaf] = point
        self.copies[t, leaf] = 1
        return leaf

    def _insert(self, trees: np.ndarray, point: np.ndarray) -> np.ndarray:
        """Add a point to trees; its leaves."""
        found = np.zeros(len(trees), np.int32)
        bare = np.flatnonzero(self.used[trees] == 0)
        if bare.size:
            found[bare] = self._new_leaf(trees[bare], point)
            self.root[trees[bare]] = ~found[bare]
        here = np.flatnonzero(self.used[trees] > 0) if not bare.size else np.setdiff1d(np.arange(len(trees)), bare)
        at, above, side = self.root[trees], np.full(len(trees), -1, np.int32), np.zeros(len(trees), int)
        while here.size:
            t, n = trees[here], at[here]
            low, high, sizes = self._boxes(t, n)
            leaf = n < 0
            same = leaf & (low == point).all(1)
            if same.any():
                found[here[same]] = ~n[same]
                self.copies[t[same], ~n[same]] += 1
                keep = ~same
                here, t, n, leaf, low, high, sizes = here[keep], t[keep], n[keep], leaf[keep], low[keep], high[keep], sizes[keep]
                if not here.size:
                    break
            # a random cut of the box with the point in it
            row = np.arange(len(here))
            wide_low, wide_high = np.minimum(low, point), np.maximum(high, point)
            span = wide_high - wide_low
            ends = span.cumsum(1)
            width = ends[:, -1]
            along = self.rng.random(len(here)) * width
            dim = np.minimum((ends < along[:, None]).sum(1), len(point) - 1)
            cut = wide_low[row, dim] + along - (ends[row, dim] - span[row, dim])
            x = point[dim]
            parts = ((x <= cut) & (cut < low[row, dim])) | ((high[row, dim] <= cut) & (cut < x))
            rounded = leaf & ~parts  # rounding: part the leaf from the point halfway in the widest dimension
            if rounded.any():
                widest = span[rounded].argmax(1)
                a, b = wide_low[rounded, widest], wide_high[rounded, widest]
                dim[rounded], cut[rounded] = widest, np.where((a + b) / 2 < b, (a + b) / 2, a)
                parts |= rounded
            if parts.any():
                t2, n2, here2 = t[parts], n[parts], here[parts]
                new = self.free_cuts[t2, self.used[t2] - 1]
                leaf2 = self._new_leaf(t2, point)
                found[here2] = leaf2
                self._box(t2, new, wide_low[parts], wide_high[parts], width[parts])
                self.sizes[t2, new] = sizes[parts] + 1
                self.dims[t2, new], self.cuts[t2, new] = dim[parts], cut[parts]
                first = point[dim[parts]] <= cut[parts]
                self.kids[t2, new, 0], self.kids[t2, new, 1] = np.where(first, ~leaf2, n2), np.where(first, n2, ~leaf2)
                self._hang(t2, above[here2], side[here2], new)
            go = ~parts
            here, t, n = here[go], t[go], n[go]
            self._box(t, n, wide_low[go], wide_high[go], width[go])
            self.sizes[t, n] += 1
            turn = (point[self.dims[t, n]] > self.cuts[t, n]).astype(int)
            above[here], side[here], at[here] = n, turn, self.kids[t, n, turn]
        return found

    def _box(self, t: np.ndarray, n: np.ndarray, low: np.ndarray, high: np.ndarray, width: np.ndarray) -> None:
        self.low[t, n], self.high[t, n], self.widths[t, n] = low, high, width

    def _hang(self, t: np.ndarray, above: np.ndarray, side: np.ndarray, node: np.ndarray) -> None:
        """Put nodes below others, or at the root where above is negative."""
        top = above < 0
        self.root[t[top]] = node[top]
        self.kids[t[~top], above[~top], side[~top]] = node[~top]

    def _remove(self, trees: np.ndarray, leaves: np.ndarray) -> None:
        """Take one point of a leaf of each tree away."""
        points = self.points[trees, leaves]
        self.copies[trees, leaves] -= 1
        every, at = np.arange(len(trees)), self.root[trees]
        path, turns = [], []  # of all trees, -1 past the leaf
        while (inner := at >= 0).any():
            n, t = at[inner], trees[inner]
            self.sizes[t, n] -= 1
            turn = (points[every[inner], self.dims[t, n]] > self.cuts[t, n]).astype(int)
            path.append(np.where(inner, at, -1))
            turns.append(np.zeros(len(trees), int))
            turns[-1][inner] = turn
            at = at.copy()
            at[inner] = self.kids[t, n, turn]
        gone = np.flatnonzero(self.copies[trees, leaves] == 0)
        t = trees[gone]
        self.used[t] -= 1
        self.free_leaves[t, self.used[t]] = leaves[gone]
        if not path:
            return
        path, turns = np.stack(path), np.stack(turns)
        depth = (path >= 0).sum(0)
        gone = gone[depth[gone] > 0]
        t, level = trees[gone], depth[gone] - 1
        last = path[level, gone]
        other = self.kids[t, last, 1 - turns[level, gone]]
        self.free_cuts[t, self.used[t] - 1] = last
        level -= 1
        self._hang(t, np.where(level < 0, -1, path[level, gone]), turns[level, gone], other)
        # a box shrinks only where the point lay on its side, and so do those above
        while True:
            keep = level >= 0
            gone, level = gone[keep], level[keep]
            t, n = trees[gone], path[level, gone]
            keep = ((self.low[t, n] == points[gone]) | (self.high[t, n] == points[gone])).any(1)
            gone, level, t, n = gone[keep], level[keep], t[keep], n[keep]
            if not gone.size:
                return
            (low, high, _), (low2, high2, _) = (self._boxes(t, self.kids[t, n, k]) for k in (0, 1))
            low, high = np.minimum(low, low2), np.maximum(high, high2)
            self._box(t, n, low, high, (high - low).sum(1))
            level -= 1
