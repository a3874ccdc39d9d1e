"""Isolation forest invariants (no upstream code to compare against)."""

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from ledgerlake.operators import forest as FO
from ledgerlake.plans.registry import silver_df


def _model(spark, trees=30, psi=128, seed=7):
    s = silver_df(spark, SF01)
    return s, FO.train_forest(s, trees, psi, seed)


def test_tree_shape_and_sample_bound(spark):
    s, nodes = _model(spark)
    pdf = nodes.toPandas()
    assert pdf["tree_id"].nunique() == 30
    roots = pdf[pdf["node_id"] == 0]
    assert (roots["size"] == 128).all()                 # exactly psi rows per tree
    assert pdf["depth"].max() <= 7                      # ceil(log2(128))
    leaves = pdf[pdf["feature"] < 0]
    assert leaves.groupby("tree_id")["size"].sum().eq(128).all()


def test_deterministic(spark):
    s, a = _model(spark)
    _, b = _model(spark)
    assert a.exceptAll(b).count() == 0


def test_scores_and_credits(spark):
    s, nodes = _model(spark)
    scored = FO.score(s, nodes, threshold=0.6, with_credits=True)
    pdf = scored.select("event_id", "amount", "fraud_score", "path_deficit", "credits",
                        "top_feature_1", "top_feature_2", "top_feature_3", "is_anomaly").toPandas()
    assert ((pdf["fraud_score"] > 0) & (pdf["fraud_score"] <= 1)).all()
    credits = np.stack(pdf["credits"].to_numpy())
    assert np.allclose(credits.sum(axis=1), pdf["path_deficit"], atol=1e-9)
    # planted huge amounts (value * 1e6 + 60000) are the most isolated points
    planted = pdf[pdf["amount"] > 60000]
    assert len(planted) > 0
    assert planted["fraud_score"].median() > pdf["fraud_score"].quantile(0.90)
    assert planted["fraud_score"].min() > pdf["fraud_score"].median()
    top3 = planted[["top_feature_1", "top_feature_2", "top_feature_3"]]
    assert top3.eq("amount").any(axis=1).all()
    assert (planted["top_feature_1"] == "amount").mean() >= 0.5
    assert (pdf["is_anomaly"] == (pdf["fraud_score"] >= 0.6)).all()


def test_threshold_and_signals_shape(spark):
    s = silver_df(spark, SF01)
    sig = FO.fraud_signals(FO.score_silver(s, n_trees=20, sample_size=64, seed=1))
    assert sig.columns[:3] == ["event_id", "event_timestamp", "user_id"]
    assert dict(sig.dtypes)["amount"] == "decimal(12,2)"
    r = sig.agg(F.avg(F.col("is_anomaly").cast("double")).alias("rate"),
                F.countDistinct("anomaly_threshold").alias("k")).first()
    assert r.k == 1 and 0.005 < r.rate < 0.2


def test_model_size_is_checked(spark, monkeypatch):
    s, nodes = _model(spark, trees=2, psi=16)
    monkeypatch.setattr(FO, "MAX_MODEL_NODES", 3)
    import pytest
    with pytest.raises(ValueError):
        FO.load_model(nodes)


def test_failing_quality_gate_blocks_retraining(spark):
    import pytest
    from ledgerlake.operators import expectations as EX
    s = silver_df(spark, SF01)
    summary = EX.summarise(EX.run_expectations(s))          # 0.6667 < 0.95
    assert not EX.passes_gate(summary)
    with pytest.raises(RuntimeError):
        FO.score_silver(s, quality_summary=summary, n_trees=5, sample_size=32)
    clean = s.filter("dq_passed = true")
    assert EX.passes_gate(EX.summarise(EX.run_expectations(clean, EX.SUITE[:6])))


def test_model_broadcast_is_reused(spark):
    s, nodes = _model(spark, trees=3, psi=32)
    m = FO.load_model(nodes)
    FO.score(s.limit(10), m, threshold=0.5)
    first = m["_broadcast"]
    FO.score(s.limit(10), m, threshold=0.5)
    assert m["_broadcast"] is first
