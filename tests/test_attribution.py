"""M3 as Shapley values: against all subsets, and on whole forests."""

from itertools import combinations
from math import factorial

import numpy as np
from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake.operators import attribution as AT
from ledgerlake.operators import forest as FO
from ledgerlake.plans.registry import silver_df

M = len(FO.FEATURES)


def expected_path(tree, x, known, node=0):
    """Path length when only the splits on ``known`` features follow x."""
    f = tree["feature"][node]
    if f < 0:
        return tree["value"][node]
    left, right = tree["left"][node], tree["right"][node]
    if f in known:
        return expected_path(tree, x, known, left if x[f] < tree["threshold"][node] else right)
    return sum(tree["size"][c] / tree["size"][node] * expected_path(tree, x, known, c) for c in (left, right))


def by_subsets(tree, x):
    out = np.zeros(M)
    for i in range(M):
        rest = [j for j in range(M) if j != i]
        for k in range(M):
            w = factorial(k) * factorial(M - 1 - k) / factorial(M)
            for s in combinations(rest, k):
                out[i] += w * (expected_path(tree, x, {*s, i}) - expected_path(tree, x, set(s)))
    return out


def small_model(seed, rows=60, psi=24, trees=4):
    rng = np.random.default_rng(seed)
    import pandas as pd
    frames = []
    for t in range(trees):
        pdf = pd.DataFrame({"amount": rng.choice([1.0, 2.5, 700.0, -1.0, 30.0], rows) + rng.random(rows) * (t % 2),
                            "event_hour": rng.integers(0, 24, rows), "is_online": rng.integers(0, 2, rows),
                            "is_high_risk_country": rng.integers(-1, 2, rows), "merchant_category": rng.integers(1, 11, rows),
                            "card_type": rng.integers(1, 4, rows), "u": rng.random(rows), "tree_id": t})
        frames.append(FO._grow(pdf, psi, seed))
    nodes = pd.concat(frames)

    class Rows:                                      # what load_model needs of a DataFrame
        def limit(self, n):
            return self

        def toPandas(self):
            return nodes
    return FO.load_model(Rows()), rng


def test_values_equal_enumeration_of_all_subsets():
    for seed in range(3):
        model, rng = small_model(seed)
        forest = AT.Forest(model)
        X = np.stack([rng.choice([1.0, 2.5, 700.0, -1.0, 30.5, np.nan, np.inf], 12), rng.integers(-1, 25, 12), rng.integers(-1, 2, 12),
                      rng.integers(-1, 2, 12), rng.integers(-1, 12, 12), rng.integers(-1, 5, 12)], axis=1).astype(float)
        # values that lie on thresholds
        X[0, 0] = forest.trees[0]["threshold"][0] if forest.trees[0]["feature"][0] == 0 else X[0, 0]
        credits, path, expected = forest.credits(X)
        want = -np.mean([[by_subsets(t, x) for x in X] for t in forest.trees], axis=0)
        assert np.abs(credits - want).max() < 1e-9
        assert np.abs(credits.sum(axis=1) - (expected - path)).max() < 1e-9
        assert np.allclose(path, FO._score_matrix(X, model)[2])


def test_tables_kept_or_made_anew_and_chunks_agree(monkeypatch):
    model, rng = small_model(5)
    X = rng.random((50, M)) * 20
    whole = AT.Forest(model).credits(X)
    monkeypatch.setattr(AT, "KEPT_LEAVES", 0)
    monkeypatch.setattr(AT, "MAX_PAIRS", 40)
    again = AT.Forest(model).credits(X)
    assert np.allclose(whole[0], again[0]) and np.allclose(whole[1], again[1]) and whole[2] == again[2]
    empty = AT.Forest(model).credits(np.zeros((0, M)))
    assert empty[0].shape == (0, M)


def test_a_feature_that_never_splits_gets_nothing():
    value, zero = np.array([3.0, 5.0]), np.array([[0.5, 1, 1, 1, 1, 1], [0.5, 1, 1, 1, 1, 1]])
    table = AT.leaf_tables(value, zero)
    assert np.all(table[:, 63, 1:] == 0) and np.allclose(table[:, 63, 0], value * 0.5)


def test_shap_over_silver(spark):
    s = silver_df(spark, SF001)
    nodes = FO.train_forest(s, 20, 64, 3)
    model = FO.load_model(nodes)
    out = AT.shap(s.withColumn("path_length", F.lit("clash")), model)
    assert out.columns.count("path_length") == 1
    pdf = out.select("event_id", "amount", "fraud_score", "path_length", "expected_path", "shap_credits", "top_feature_1").toPandas()
    assert len(pdf) == s.count() and pdf["expected_path"].nunique() == 1
    credits = np.stack(pdf["shap_credits"].to_numpy())
    assert np.allclose(credits.sum(axis=1), pdf["expected_path"] - pdf["path_length"], atol=1e-9)
    scores = FO.score(s, model).select("event_id", "fraud_score").toPandas()
    assert np.allclose(np.sort(pdf["fraud_score"]), np.sort(scores["fraud_score"]))
    planted = pdf[pdf["amount"] > 60000]
    assert len(planted) and (planted["top_feature_1"] == "amount").mean() > 0.5
    imp = {r.feature: r for r in AT.importance(out).collect()}
    assert set(imp) == set(FO.FEATURES) and sum(r.top_rows for r in imp.values()) == len(pdf)
    assert np.isclose(imp["amount"].mean_credit, credits[:, 0].mean()) and np.isclose(imp["amount"].mean_magnitude, np.abs(credits[:, 0]).mean())
    assert AT.shap(s.limit(0), model).count() == 0 and AT.importance(AT.shap(s.limit(0), model)).count() == 0
