"""M3: Shapley values of an isolation forest's path lengths.

Method: Lundberg et al. 2018, path-dependent.  The game of a row x gives a set S
of features the expected path length of x when the splits on S follow x and
those on other features follow the training rows' shares.  For one leaf that is

    value(leaf) * prod over S of one_f(x) * prod outside S of zero_f

where one_f says whether x meets the leaf's conditions on f, and zero_f is the
product of the shares along the leaf's path where f splits.  A feature that does
not split there has one = zero = 1 and gets nothing.  Feature i's value is

    value(leaf) * (one_i - zero_i) * sum over k of w_k * e_k,   w_k = k! (M-1-k)! / M!

with e_k the sum over the subsets of k other features, the coefficient of t^k in the
product of (zero_j + one_j t): the path's weights, extended feature by feature.

one_f(x) is 0 or 1, so a leaf has 2^M patterns; their values are worked out once
for each leaf (``leaf_tables``).  The rows of a chunk are then sorted into cells by
the places of their feature values among a tree's thresholds (``cells``); the sums
over the leaves are made once for each cell, and a row looks its cell up.  No step is
a row at a time, nor a (row, leaf) pair.

Credits are minus the Shapley values: positive where a feature makes a row easier to
isolate.  They add up to ``expected_path - path_length``.
"""

from __future__ import annotations

from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import cells as CE
from ledgerlake.operators import forest as FO
from ledgerlake.session import spread

#: pairs of a wide and a narrow cell in one tree's table; bounds a task's memory
MAX_PAIRS = 400_000
#: leaves whose tables a task keeps; beyond it a tree's table is made when needed
KEPT_LEAVES = 50_000


class TreeTable(CE.TreeCells):
    """One tree and what it says of every pair of cells."""

    def __init__(self, tree: dict, cuts: list[np.ndarray]):
        super().__init__(tree, cuts)
        self.expected = float((self.value * self.zero.prod(axis=1)).sum())
        # of every leaf and pattern the Shapley values, and the leaf's value where all features agree
        path = np.zeros((self.leaves, 1 << self.features, 1))
        path[:, -1, 0] = self.value
        self.table = np.concatenate([leaf_tables(self.value, self.zero), path], axis=2)

    def add(self, chunk: CE.Chunk, out: np.ndarray) -> None:
        """Add every row's Shapley values and path length to ``out``.

        The value of a pair of cells is the sum over the leaves of the entry at the
        leaf's pattern: the wide cell picks one of a few patterns for each leaf, the
        narrow cell the entries for each of them, so all pairs are one matrix product."""
        wide, narrow, a, b = self.cells(chunk)
        if len(wide) * len(narrow) > MAX_PAIRS and chunk.rows > 1:
            for part, half in chunk.halves():
                self.add(half, out[part])
            return
        n = 1 << len(CE.WIDE)
        by_wide = self.table.reshape(self.leaves, -1, n, self.features + 1)
        entries = by_wide[np.arange(self.leaves), narrow].transpose(2, 1, 0, 3).reshape(n * self.leaves, -1)
        picked = (wide[:, None, :] == np.arange(n)[:, None]).reshape(len(wide), -1).astype(float)
        pairs = (picked @ entries).reshape(-1, self.features + 1)
        out += pairs[a * len(narrow) + b]


def leaf_tables(value: np.ndarray, zero: np.ndarray) -> np.ndarray:
    """(leaves, 2^M, M): every feature's Shapley value for every pattern."""
    n, m = zero.shape
    one = ((np.arange(1 << m)[:, None] >> np.arange(m)) & 1).astype(float)         # (2^M, M)
    weights = np.array([factorial(k) * factorial(m - 1 - k) / factorial(m) for k in range(m)])
    out = np.empty((n, 1 << m, m))
    for i in range(m):
        # sums over the subsets of the other features, by their size
        sums = np.zeros((n, 1 << m, m))
        sums[:, :, 0] = 1.0
        for j in (j for j in range(m) if j != i):
            grown = sums * zero[:, None, j, None]
            grown[:, :, 1:] += sums[:, :, :-1] * one[None, :, j, None]
            sums = grown
        out[:, :, i] = value[:, None] * (one[None, :, i] - zero[:, None, i]) * (sums @ weights)
    return out


class Forest:
    """All trees of a loaded model (``forest.load_model``)."""

    def __init__(self, model: dict, features: int = len(FO.FEATURES)):
        self.trees, self.cuts = CE.split_trees(model), CE.thresholds(model, features)
        self.features = features
        leaves = int((model["feature"] < 0).sum())
        self.kept = [TreeTable(t, self.cuts) for t in self.trees] if leaves <= KEPT_LEAVES else None

    def tables(self):
        return self.kept if self.kept is not None else (TreeTable(t, self.cuts) for t in self.trees)

    def credits(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """(credits, path lengths, expected path length), means over the trees."""
        out, expected, chunk = np.zeros((len(X), self.features + 1)), 0.0, CE.Chunk(self.cuts, X)
        for tree in self.tables():
            if len(X):
                tree.add(chunk, out)
            expected += tree.expected
        out /= len(self.trees)
        return -out[:, :-1], out[:, -1], expected / len(self.trees)


def shap(tx: DataFrame, nodes: DataFrame | dict) -> DataFrame:
    """Every input row plus ``fraud_score``, ``path_length``, ``expected_path``,
    ``shap_credits`` (in the order of ``forest.FEATURES``) and ``top_feature_1..3``,
    the features of the largest credits (ties in feature order)."""
    model = nodes if isinstance(nodes, dict) else FO.load_model(nodes)
    sent = FO.broadcast_model(tx.sparkSession, model)
    staged = FO.score_columns(spread(tx))
    columns = [f"_f_{n}" for n in FO.FEATURES]
    new = [T.StructField(c, T.DoubleType()) for c in ("fraud_score", "path_length", "expected_path")]
    new += [T.StructField("shap_credits", T.ArrayType(T.DoubleType()))]
    new += [T.StructField(f"top_feature_{k}", T.StringType()) for k in (1, 2, 3)]
    keep = [c for c in staged.columns if c not in columns and c not in {f.name for f in new}]
    names = pa.array(FO.FEATURES)

    def run(batches):
        forest = Forest(sent.value)
        for held in CE.in_chunks(batches):
            every, path, expected = forest.credits(np.concatenate([FO.feature_matrix(b, columns) for b in held]))
            ends = np.cumsum([b.num_rows for b in held])
            for b, credits, p in zip(held, np.split(every, ends), np.split(path, ends)):
                top = np.argsort(-credits, axis=1, kind="stable")[:, :3]
                made = [pa.array(np.power(2.0, -p / sent.value["c_psi"])), pa.array(p), pa.array(np.full(len(p), expected)),
                        FO.list_array(credits), *(names.take(pa.array(top[:, k])) for k in range(3))]
                yield pa.RecordBatch.from_arrays([*(b.column(c) for c in keep), *made], names=[*keep, *(f.name for f in new)])

    return staged.mapInArrow(run, T.StructType([*(staged.schema[c] for c in keep), *new]))


def importance(explained: DataFrame) -> DataFrame:
    """(feature, mean_credit, mean_magnitude, top_rows): how much each feature
    moves the scored rows, as one combinable aggregate."""
    sums = explained.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(F.col("shap_credits")[i]).alias(f"s{i}") for i in range(len(FO.FEATURES))],
        *[F.sum(F.abs(F.col("shap_credits")[i])).alias(f"m{i}") for i in range(len(FO.FEATURES))],
        *[F.count_if(F.col("top_feature_1") == f).alias(f"t{i}") for i, f in enumerate(FO.FEATURES)])
    rows = F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f"s{i}") / F.col("n")).alias("mean_credit"),
                              (F.col(f"m{i}") / F.col("n")).alias("mean_magnitude"), F.col(f"t{i}").alias("top_rows"))
                     for i, f in enumerate(FO.FEATURES)])
    return sums.where("n > 0").select(F.inline(rows))
