"""Scores and Shapley values by cells: what a chunk costs grows with the cells that
occur, not with rows times leaves."""

import numpy as np
import pyarrow as pa

from ledgerlake.operators import attribution as AT
from ledgerlake.operators import cells as CE
from ledgerlake.operators import forest as FO
from test_attribution import small_model


def _rows(rng, n):
    return np.stack([rng.choice([1.0, 2.5, 700.0, -1.0, 30.5, np.nan], n), rng.integers(-1, 24, n), rng.integers(-1, 2, n),
                     rng.integers(-1, 2, n), rng.integers(-1, 11, n), rng.integers(-1, 4, n)], axis=1).astype(float)


def _walk(tree, x):
    node, credit = 0, np.zeros(len(x))
    while tree["feature"][node] >= 0:
        f = tree["feature"][node]
        child = tree["left"][node] if x[f] < tree["threshold"][node] else tree["right"][node]
        credit[f] += tree["value"][node] - tree["value"][child]
        node = child
    return node, credit


def test_leaves_and_credits_equal_a_walk_down_each_tree():
    model, rng = small_model(11, rows=200, psi=128)
    X, trees = _rows(rng, 300), CE.split_trees(model)
    X[:5, 0] = CE.thresholds(model, 6)[0][:5]                      # on a threshold: to the right
    scorer = FO.Scorer(model)
    chunk = CE.Chunk(scorer.cuts, X)
    for tree, cells in zip(trees, scorer.trees):
        assert [cells.nodes[k] for k in cells.leaf(chunk)] == [_walk(tree, x)[0] for x in X]
    _, credits, _ = scorer.score(X)
    assert np.allclose(credits, np.mean([[_walk(t, x)[1] for x in X] for t in trees], axis=0))


def test_more_rows_of_the_same_values_make_no_more_cells():
    model, rng = small_model(3, rows=200, psi=64)
    X = _rows(rng, 2_000)
    forest = AT.Forest(model)
    few, many = CE.Chunk(forest.cuts, X), CE.Chunk(forest.cuts, np.tile(X, (20, 1)))
    for tree in forest.tables():
        a, b = tree.cells(few), tree.cells(many)
        assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])
        assert len(a[0]) * len(a[1]) < 20 * len(X)
    assert np.allclose(np.tile(forest.credits(X)[0], (20, 1)), forest.credits(np.tile(X, (20, 1)))[0])


def test_batches_are_held_by_rows():
    batches = [pa.record_batch({"x": list(range(n))}) for n in (3, 4, 0, 9, 1)]
    assert [[b.num_rows for b in held] for held in CE.in_chunks(batches, 7)] == [[3, 4], [0, 9], [1]]
    assert list(CE.in_chunks([])) == []
