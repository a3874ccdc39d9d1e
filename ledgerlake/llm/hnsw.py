"""A hierarchical navigable small-world graph over one shard of unit vectors.

A small numpy helper for tasks: nodes are inserted, and queries searched, in
batches, so that each step works on arrays.  Layer l holds the nodes whose
level is at least l; levels fall off geometrically.
"""

from __future__ import annotations

import io

import numpy as np

DEGREE = 16                    # neighbours a node has on the upper layers; twice as many on layer 0
BUILD_BEAM = 64
BATCH = 256                    # queries that are searched together
EXPAND = 4                     # nodes opened in one step for each of them


def _top(ids, sims, k, flags=None):
    """The k columns of largest similarity in each row."""
    if ids.shape[1] > k:
        at = np.argpartition(-sims, k - 1, axis=1)[:, :k]
        ids, sims = np.take_along_axis(ids, at, 1), np.take_along_axis(sims, at, 1)
        flags = None if flags is None else np.take_along_axis(flags, at, 1)
    return ids, sims, flags


def _sorted(ids, sims):
    at = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, at, 1), np.take_along_axis(sims, at, 1)


def beam(vecs, links, queries, entries, width):
    """(ids, similarities) of the ``width`` best nodes met from ``entries``
    (rows of node ids, -1 for none), best first; -1 where fewer were met."""
    n, rows = len(vecs), len(queries)
    width = min(width, n)
    seen = np.zeros((rows, n), bool)
    line = np.arange(rows)[:, None]
    seen[line, np.where(entries >= 0, entries, entries[:, :1])] = True
    sims = np.where(entries >= 0, np.einsum("rkd,rd->rk", vecs[entries], queries), -np.inf).astype(np.float32)
    pad = max(0, width - entries.shape[1])
    ids = np.pad(entries, ((0, 0), (0, pad)), constant_values=-1)
    sims = np.pad(sims, ((0, 0), (0, pad)), constant_values=-np.inf)
    ids, sims, _ = _top(ids, sims, width)
    opened = ids < 0
    while True:
        waiting = np.where(opened, -np.inf, sims)
        live = np.flatnonzero(np.isfinite(waiting).any(1))
        if not len(live):
            return _sorted(ids, sims)
        w = waiting[live]
        k = min(EXPAND, width)
        pick = np.argpartition(-w, k - 1, axis=1)[:, :k] if k < width else np.tile(np.arange(width), (len(live), 1))
        real = np.isfinite(np.take_along_axis(w, pick, 1))
        chosen = np.where(real, ids[live[:, None], pick], -1)
        flags = opened[live]
        np.put_along_axis(flags, pick, True, 1)
        near = np.where(chosen[:, :, None] >= 0, links[chosen], -1).reshape(len(live), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[(near >= 0) & seen[live[:, None], near]] = -1
        r, c = np.nonzero(near >= 0)
        seen[live[r], near[r, c]] = True
        s = np.full(near.shape, -np.inf, np.float32)
        s[r, c] = np.einsum("kd,kd->k", vecs[near[r, c]], queries[live[r]])
        ids[live], sims[live], opened[live] = _top(
            np.concatenate([ids[live], near], 1), np.concatenate([sims[live], s], 1), width,
            np.concatenate([flags, near < 0], 1))


def select(vecs, ids, sims, most):
    """Up to ``most`` neighbours from candidates sorted best first: first those
    nearer to the node than to any chosen before, then the nearest others.
    The first rule keeps links between groups of near copies."""
    cand = vecs[ids]
    pair = np.einsum("rad,rbd->rab", cand, cand, optimize=True)
    keep = np.zeros(ids.shape, bool)
    for c in range(ids.shape[1]):
        blocked = ((pair[:, c] > sims[:, c, None]) & keep).any(1)
        keep[:, c] = (ids[:, c] >= 0) & ~blocked & (keep.sum(1) < most)
    order = np.argsort(np.where(keep, 0, np.where(ids >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(ids, order, 1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


class Graph:
    def __init__(self, vecs: np.ndarray, layers: list[np.ndarray], tops: np.ndarray):
        self.vecs, self.layers, self.tops = vecs, layers, tops

    @classmethod
    def build(cls, vecs: np.ndarray, chance: np.ndarray) -> Graph:
        """``vecs``: unit vectors; ``chance``: a uniform number in (0, 1] for each."""
        n = len(vecs)
        level = np.floor(-np.log(chance) / np.log(DEGREE)).astype(int)
        level = np.minimum(level, max(0, int(np.log(max(n, 2)) / np.log(DEGREE))))
        top = int(level.max()) if n else 0
        graph = cls(vecs, [np.empty(0)] * (top + 1), np.flatnonzero(level == top)[:BUILD_BEAM])
        for layer in range(top, -1, -1):
            order = np.argsort(-level, kind="stable")
            graph._fill(layer, order[level[order] >= layer])
        return graph

    def _fill(self, layer: int, nodes: np.ndarray) -> None:
        most = DEGREE * (1 if layer else 2)
        links = self.layers[layer] = np.full((len(self.vecs), most), -1, np.int32)
        at = 0
        while at < len(nodes):
            new = nodes[at:at + min(2 * BATCH, max(32, at))]
            v = self.vecs[new]
            among = v @ v.T
            np.fill_diagonal(among, -np.inf)
            k = min(len(new), most)
            ids, sims, _ = _top(np.tile(new, (len(new), 1)), among, k)
            if at:
                found, s = self._search(v, layer, BUILD_BEAM, nodes[:1])
                ids, sims = np.concatenate([ids, found], 1), np.concatenate([sims, s], 1)
            ids = np.where(np.isfinite(sims), ids, -1)
            ids, sims = _sorted(ids, sims)
            links[new] = select(self.vecs, ids, sims, most)
            self._back(links, new, most)
            at += len(new)

    def _back(self, links: np.ndarray, new: np.ndarray, most: int) -> None:
        """Add the links' other directions; where a list overflows, select anew."""
        target = links[new].ravel()
        source = np.repeat(new, most)[target >= 0]
        target = target[target >= 0]
        sim = np.einsum("kd,kd->k", self.vecs[target], self.vecs[source])
        order = np.lexsort((-sim, target))
        target, source = target[order], source[order]
        hosts, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        fit = place < 2 * most
        added = np.full((len(hosts), min(int(count.max(initial=0)), 2 * most)), -1, np.int32)
        added[np.repeat(np.arange(len(hosts)), count)[fit], place[fit]] = source[fit]
        for at in range(0, len(hosts), BATCH):
            part = hosts[at:at + BATCH]
            ids = np.concatenate([links[part], added[at:at + BATCH]], 1)
            ids.sort(axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = np.where(ids >= 0, np.einsum("rkd,rd->rk", self.vecs[ids], self.vecs[part]), -np.inf)
            links[part] = select(self.vecs, *_sorted(ids, sims), most)

    def _search(self, queries: np.ndarray, layer: int, width: int, start: np.ndarray):
        """Descend to ``layer`` and search it; ``start`` is met if nothing is above."""
        outs = []
        for at in range(0, len(queries), BATCH):
            q = queries[at:at + BATCH]
            ids = np.tile(start if layer == len(self.layers) - 1 else self.tops[:1], (len(q), 1)).astype(np.int32)
            for upper in range(len(self.layers) - 1, layer, -1):
                ids = beam(self.vecs, self.layers[upper], q, ids, 4)[0]
            outs.append(beam(self.vecs, self.layers[layer], q, ids, width))
        wide = max(o[0].shape[1] for o in outs)
        return tuple(np.concatenate([np.pad(o[i], ((0, 0), (0, wide - o[i].shape[1])), constant_values=fill)
                                     for o in outs]) for i, fill in ((0, -1), (1, -np.inf)))

    def within(self, queries: np.ndarray, least: float, width: int) -> list[np.ndarray]:
        """For each query the nodes found with at least that similarity.  Where
        all of a beam qualifies, the query's beam doubles, up to the whole shard."""
        out: list = [None] * len(queries)
        todo = np.arange(len(queries))
        while len(todo):
            left = []
            step = max(1, BATCH * 64 // max(64, width))
            for at in range(0, len(todo), step):
                part = todo[at:at + step]
                ids, sims = self._search(queries[part], 0, width, self.tops[:1])
                for r, i in enumerate(part):
                    good = sims[r] >= least
                    if good.all() and ids.shape[1] < len(self.vecs):
                        left.append(i)
                    else:
                        out[i] = ids[r][good]
            todo = np.array(left, int)
            width *= 2
        return out

    def to_bytes(self, **more: np.ndarray) -> bytes:
        raw = io.BytesIO()
        np.savez(raw, vecs=self.vecs, tops=self.tops, **{f"layer{i}": x for i, x in enumerate(self.layers)}, **more)
        return raw.getvalue()

    @classmethod
    def from_bytes(cls, raw: bytes) -> tuple[Graph, dict[str, np.ndarray]]:
        got = dict(np.load(io.BytesIO(raw)))
        layers = [got[f"layer{i}"] for i in range(sum(k.startswith("layer") for k in got))]
        return cls(got["vecs"], layers, got["tops"]), got
