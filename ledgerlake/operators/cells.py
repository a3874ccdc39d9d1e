"""Rows against the trees of an isolation forest, by cells.

A tree sees of a row only the place of each feature value among the tree's
thresholds, so what it says of a row (its leaf, its Shapley values) is the same for
all rows of a cell.  Features fall into two groups: ``WIDE``, those of many values,
and the rest.  A chunk of rows holds a few hundred wide cells and a few dozen narrow
ones for each tree; a tree's answers are worked out once for each pair of them, and a
row costs a lookup, however many leaves there are.

The places among the thresholds of the whole forest are found once for a chunk; a
tree's own places follow from them by a lookup.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: features whose cells make the rows of a tree's table: amount and hour
WIDE = (0, 1)
#: rows that share one set of tables; bounds what a task holds
CHUNK_ROWS = 100_000


def in_chunks(batches: Iterable[pa.RecordBatch], rows: int = CHUNK_ROWS) -> Iterator[list[pa.RecordBatch]]:
    """Consecutive batches of about ``rows`` rows together."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield held
            held, n = [], 0
    if held:
        yield held


def tree_leaves(tree: dict, features: int):
    """Of each leaf: its node, the interval [low, high) of every feature, the features'
    products of shares, and the drops of the value along its path by feature."""
    size, value, nodes, lows, highs, zeros, drops = tree["size"], tree["value"], [], [], [], [], []
    stack = [(0, np.full(features, -np.inf), np.full(features, np.inf), np.ones(features), np.zeros(features))]
    while stack:
        node, low, high, zero, drop = stack.pop()
        f = tree["feature"][node]
        if f < 0:
            for held, x in ((nodes, node), (lows, low), (highs, high), (zeros, zero), (drops, drop)):
                held.append(x)
            continue
        for child, left in ((tree["left"][node], True), (tree["right"][node], False)):
            a, b, z, d = low.copy(), high.copy(), zero.copy(), drop.copy()
            if left:
                b[f] = min(b[f], tree["threshold"][node])
            else:
                a[f] = max(a[f], tree["threshold"][node])
            z[f] *= size[child] / size[node]
            d[f] += value[node] - value[child]
            stack.append((child, a, b, z, d))
    return np.array(nodes), np.array(lows), np.array(highs), np.array(zeros), np.array(drops)


def split_trees(model: dict) -> list[dict]:
    """The trees of a loaded model (``forest.load_model``), each with its own node numbers."""
    ends = [*model["offsets"][1:], len(model["feature"])]
    trees = [{k: model[k][a:b] for k in ("feature", "threshold", "left", "right", "value", "size")}
             for a, b in zip(model["offsets"], ends)]
    return [t | {k: t[k] - a for k in ("left", "right")} for t, a in zip(trees, model["offsets"])]


def thresholds(model: dict, features: int) -> list[np.ndarray]:
    """All thresholds of the forest, by feature."""
    return [np.unique(model["threshold"][model["feature"] == f]) for f in range(features)]


class Chunk:
    """Rows by their places among the forest's thresholds: those of the wide features
    row by row, those of the narrow ones as the few kinds that occur."""

    def __init__(self, cuts: list[np.ndarray], X: np.ndarray):
        self.rows = len(X)
        self.places = [np.searchsorted(c, X[:, f], "right") for f, c in enumerate(cuts)]
        self.kind, first = np.zeros(len(X), np.int64), np.zeros(min(1, len(X)), np.int64)
        for f in range(len(cuts)):
            if f not in WIDE:
                _, place = np.unique(self.places[f], return_inverse=True)
                _, first, self.kind = np.unique(self.kind * (len(X) + 1) + place, return_index=True, return_inverse=True)
        self.kinds = [p[first] for p in self.places]

    def halves(self) -> Iterator[tuple[slice, Chunk]]:
        for part in (slice(0, self.rows // 2), slice(self.rows // 2, self.rows)):
            half = object.__new__(Chunk)
            half.rows, half.places = part.stop - part.start, [p[part] for p in self.places]
            seen, half.kind = np.unique(self.kind[part], return_inverse=True)
            half.kinds = [k[seen] for k in self.kinds]
            yield part, half


class TreeCells:
    """One tree, ready to tell the cells of a chunk."""

    def __init__(self, tree: dict, cuts: list[np.ndarray]):
        self.features = len(cuts)
        self.nodes, low, high, self.zero, self.drops = tree_leaves(tree, self.features)
        self.leaves, self.value = len(self.nodes), tree["value"][self.nodes]
        # of every place among the forest's thresholds that among the tree's own, and
        # of every place among these the leaves it agrees with
        self.place, self.agrees = [], []
        for f in range(self.features):
            own = np.unique(tree["threshold"][tree["feature"] == f])
            self.place.append(np.concatenate([[0], np.searchsorted(own, cuts[f], "right")]).astype(np.int32))
            at = np.arange(len(own) + 1)[:, None]
            self.agrees.append((at >= np.searchsorted(own, low[:, f], "right")) & (at <= np.searchsorted(own, high[:, f], "left")))

    def cells(self, chunk: Chunk):
        """(wide, narrow, wide number, narrow number): for each wide and each narrow
        cell that occurs the features that agree with each leaf, as bits in feature
        order, and the cells of every row."""
        shape = [len(self.agrees[f]) for f in WIDE]
        code = np.ravel_multi_index([self.place[f][chunk.places[f]] for f in WIDE], shape)
        seen = np.zeros(np.prod(shape), bool)
        seen[code] = True
        occur = np.flatnonzero(seen)
        number = np.empty(len(seen), np.int64)
        number[occur] = np.arange(len(occur))
        at = np.unravel_index(occur, shape)
        wide = sum((self.agrees[f][a].astype(np.uint8) << i for i, (f, a) in enumerate(zip(WIDE, at))),
                   np.zeros((len(occur), self.leaves), np.uint8))
        rest = [f for f in range(self.features) if f not in WIDE]
        every = sum((self.agrees[f][self.place[f][chunk.kinds[f]]].astype(np.uint8) << i for i, f in enumerate(rest)),
                    np.zeros((len(chunk.kinds[0]), self.leaves), np.uint8))
        narrow, same = np.unique(every, axis=0, return_inverse=True)
        return wide, narrow, number[code], same.ravel()[chunk.kind]

    def leaf(self, chunk: Chunk) -> np.ndarray:
        """The leaf of every row: the one that all its features agree with."""
        wide, narrow, a, b = self.cells(chunk)
        full = (1 << len(WIDE)) - 1, (1 << (self.features - len(WIDE))) - 1
        numbered = (narrow == full[1]) * np.arange(self.leaves, dtype=np.float32)
        pairs = ((wide == full[0]).astype(np.float32) @ numbered.T).astype(np.int32)
        return pairs.ravel()[a * len(narrow) + b]
