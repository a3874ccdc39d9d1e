"""Anomaly scoring: isolation forest (M1), scoring (M2), attribution (M3).

Method: Liu, Ting & Zhou, "Isolation Forest" (ICDM 2008).  Each tree is
grown on a sub-sample of ``sample_size`` rows with random axis-aligned
splits up to height ceil(log2(sample_size)); the score of x is
s = 2 ** (-E[h(x)] / c(sample_size)), in (0, 1], higher = more isolated.

Spark plan:
* Training never moves the table: each row hashes once to a start tree and
  is kept with a probability that gives every tree about 2 x sample_size
  rows (small tables copy a row into a few consecutive trees), so only about
  2 x sample_size x trees rows leave the scan, whatever the table size.
  ``groupBy(tree_id).applyInPandas`` grows one tree per group; a group
  holds about 2 x sample_size rows by construction, so no group can be hot.
* Trees are rows (one per node).  The model is bounded by
  trees x (2 x sample_size) nodes; that bound is checked before it is
  broadcast for scoring.
* Scoring is ``mapInArrow``: a chunk of rows is sorted into each tree's cells
  (``cells``), and a row looks up its cell's leaf.

Attribution (M3): along x's path in a tree, the value V(node) = depth +
c(size) (expected total path length of a point routed to that node) falls
from c(root size) at the root to h(x) at the leaf; each drop is credited
to the feature of the split that caused it (a path decomposition in the
spirit of Saabas' tree interpreter).  Per record the credits sum exactly to
mean over trees of c(root size) - h(x); the three largest are reported.
This is the cheap attribution of every scored row; Shapley values, which do not
depend on the order of the splits, are in ``attribution``.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import cells as CE
from ledgerlake.schemas import VALID_CATEGORIES
from ledgerlake.session import checkpoint_dir, spread

EULER_GAMMA = 0.5772156649015329
DEFAULT_TREES = 100
DEFAULT_SAMPLE = 256
DEFAULT_CONTAMINATION = 0.02     # upstream generates about 2 % fraud
MAX_MODEL_NODES = 2_000_000

CARD_TYPES = ["credit", "debit", "prepaid"]


def feature_columns() -> list[tuple[str, Column]]:
    """Model features (numeric, NULL -> -1 so every row can be scored)."""
    cat_idx = F.array_position(F.array(*[F.lit(c) for c in VALID_CATEGORIES]),
                               F.col("merchant_category"))
    card_idx = F.array_position(F.array(*[F.lit(c) for c in CARD_TYPES]), F.col("card_type"))
    out = [
        ("amount", F.coalesce(F.col("amount").cast("double"), F.lit(-1.0))),
        ("event_hour", F.coalesce(F.col("event_hour").cast("double"), F.lit(-1.0))),
        ("is_online", F.coalesce(F.col("is_online").cast("double"), F.lit(-1.0))),
        ("is_high_risk_country", F.coalesce(F.col("is_high_risk_country").cast("double"), F.lit(-1.0))),
        ("merchant_category", F.coalesce(cat_idx.cast("double"), F.lit(-1.0))),
        ("card_type", F.coalesce(card_idx.cast("double"), F.lit(-1.0))),
    ]
    assert [n for n, _ in out] == FEATURES
    return out


FEATURES = ["amount", "event_hour", "is_online", "is_high_risk_country",
            "merchant_category", "card_type"]

NODE_SCHEMA = T.StructType([
    T.StructField("tree_id", T.IntegerType(), False),
    T.StructField("node_id", T.IntegerType(), False),
    T.StructField("feature", T.IntegerType(), False),      # -1 for a leaf
    T.StructField("threshold", T.DoubleType(), False),
    T.StructField("left", T.IntegerType(), False),
    T.StructField("right", T.IntegerType(), False),
    T.StructField("size", T.LongType(), False),
    T.StructField("depth", T.IntegerType(), False),
    T.StructField("root_size", T.LongType(), False),
])


def c_factor(n) -> np.ndarray:
    """Average path length of an unsuccessful BST search among n points."""
    n = np.asarray(n, dtype=float)
    out = np.zeros_like(n)
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + EULER_GAMMA) - 2.0 * (n[big] - 1.0) / n[big]
    out[n == 2] = 1.0
    return out


def _unit_hash(*cols) -> Column:
    """Deterministic uniform number in [0, 1) from a hash of the columns."""
    h = F.xxhash64(*cols)
    return F.pmod(h, F.lit(1 << 53)).cast("double") / float(1 << 53)


def _grow(pdf: pd.DataFrame, sample_size: int, seed: int) -> pd.DataFrame:
    tree_id = int(pdf["tree_id"].iloc[0])
    pdf = pdf.nsmallest(sample_size, "u")                 # exactly min(psi, n) rows
    X = np.stack([pdf[f].to_numpy(dtype=float) for f in FEATURES], axis=1)
    rng = np.random.default_rng(seed * 1_000_003 + tree_id)
    limit = int(math.ceil(math.log2(max(sample_size, 2))))
    rows = []
    root_size = len(X)
    stack = [(0, np.arange(len(X)), 0)]
    next_id = 1
    while stack:
        node, idx, depth = stack.pop()
        pts = X[idx]
        spread = pts.max(axis=0) - pts.min(axis=0) if len(idx) else np.zeros(X.shape[1])
        splittable = np.flatnonzero(spread > 0)
        if depth >= limit or len(idx) <= 1 or len(splittable) == 0:
            rows.append((tree_id, node, -1, 0.0, -1, -1, len(idx), depth, root_size))
            continue
        f = int(rng.choice(splittable))
        lo, hi = pts[:, f].min(), pts[:, f].max()
        thr = float(rng.uniform(lo, hi))
        left_mask = pts[:, f] < thr
        if not left_mask.any() or left_mask.all():       # guard against fp edge cases
            thr = float((lo + hi) / 2.0)
            left_mask = pts[:, f] < thr
        left, right = next_id, next_id + 1
        next_id += 2
        rows.append((tree_id, node, f, thr, left, right, len(idx), depth, root_size))
        stack.append((left, idx[left_mask], depth + 1))
        stack.append((right, idx[~left_mask], depth + 1))
    return pd.DataFrame(rows, columns=NODE_SCHEMA.fieldNames())


def train_forest(silver: DataFrame, n_trees: int = DEFAULT_TREES,
                 sample_size: int = DEFAULT_SAMPLE, seed: int = 42,
                 passed_only: bool = True, n_rows: int | None = None) -> DataFrame:
    """M1: isolation forest as node rows.  Trains on ``dq_passed = true``."""
    df = silver.filter(F.col("dq_passed") == F.lit(True)) if passed_only else silver
    feats = df.select(*[e.alias(n) for n, e in feature_columns()],
                      F.coalesce(F.col("event_id"), F.lit("")).alias("_key"))
    n = feats.count() if n_rows is None else n_rows
    if n == 0:
        raise ValueError("no training rows")
    # Row r joins trees h(r), h(r)+1, ..., h(r)+K-1 (mod T), each copy kept
    # with probability q; K = ceil(2 psi T / n) copies are needed only when
    # the table is small.  P(r in tree t) = q K / T = 2 psi / n for every t,
    # rows within a tree are distinct, and for large tables (K = 1) this is
    # one hash per row with no explode at all.
    target = 2.0 * sample_size * n_trees / n
    k = max(1, min(n_trees, int(math.ceil(target))))
    q = min(1.0, target / k)
    key = [F.col("_key"), *[F.col(f) for f in FEATURES]]
    start = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(n_trees))
    copies = F.explode(F.sequence(F.lit(0), F.lit(k - 1))) if k > 1 else F.lit(0)
    sampled = (feats.select(*FEATURES, "_key", start.alias("_h"), copies.alias("_c"))
               .filter(_unit_hash(*key, F.lit(seed), F.col("_c")) < q)
               .select(*FEATURES, "_key",
                       F.pmod(F.col("_h") + F.col("_c"), F.lit(n_trees)).cast("int").alias("tree_id"))
               .withColumn("u", _unit_hash(*key, F.lit(seed + 1), F.col("tree_id"))))
    # Growing trees is CPU work on a tiny input (about 2 x psi rows per tree),
    # which AQE would coalesce into one task.  An explicit count keeps the
    # trees spread over the cores; groupBy(tree_id) reuses this partitioning.
    parts = max(1, min(n_trees, 2 * silver.sparkSession.sparkContext.defaultParallelism))
    return (sampled.repartition(parts, "tree_id").groupBy("tree_id")
            .applyInPandas(lambda pdf: _grow(pdf, sample_size, seed), NODE_SCHEMA))


def load_model(nodes: DataFrame) -> dict:
    """Node rows -> one stacked node table for all trees (collect bounded by
    MAX_MODEL_NODES).  Tree t's node i is row ``offset[t] + i``."""
    pdf = nodes.limit(MAX_MODEL_NODES + 1).toPandas()
    if len(pdf) > MAX_MODEL_NODES:
        raise ValueError("forest exceeds the broadcast size bound")
    if len(pdf) == 0:
        raise ValueError("empty forest")
    pdf = pdf.sort_values(["tree_id", "node_id"])
    sizes = pdf.groupby("tree_id")["node_id"].max().to_numpy() + 1
    offsets = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    tree_pos = {t: i for i, t in enumerate(sorted(pdf["tree_id"].unique()))}
    base = offsets[pdf["tree_id"].map(tree_pos).to_numpy()]
    total = int(sizes.sum())
    idx = base + pdf["node_id"].to_numpy()
    feature = np.full(total, -1, dtype=np.int64)
    threshold = np.zeros(total)
    left = np.zeros(total, dtype=np.int64)
    right = np.zeros(total, dtype=np.int64)
    size = np.zeros(total)
    depth = np.zeros(total)
    feature[idx] = pdf["feature"].to_numpy()
    threshold[idx] = pdf["threshold"].to_numpy()
    is_split = pdf["feature"].to_numpy() >= 0
    left[idx] = np.where(is_split, base + pdf["left"].to_numpy(), 0)
    right[idx] = np.where(is_split, base + pdf["right"].to_numpy(), 0)
    size[idx] = pdf["size"].to_numpy()
    depth[idx] = pdf["depth"].to_numpy()
    roots = pdf[pdf["node_id"] == 0].sort_values("tree_id")["root_size"].to_numpy()
    psi = float(roots.max())
    return {"feature": feature, "threshold": threshold, "left": left, "right": right,
            "value": depth + c_factor(size), "size": size, "offsets": offsets,
            "root_value": c_factor(roots),
            # c(1) = 0: a one-row sample isolates nothing; keep the score finite
            "c_psi": max(float(c_factor([psi])[0]), 1.0)}


class Scorer:
    """All trees of a loaded model: a row's leaf in each (``cells``), and what the way
    there credits to each feature."""

    def __init__(self, model: dict):
        self.cuts, self.c_psi = CE.thresholds(model, len(FEATURES)), model["c_psi"]
        self.trees = [CE.TreeCells(t, self.cuts) for t in CE.split_trees(model)]
        self.said = [np.column_stack([t.drops, t.value]) for t in self.trees]

    def score(self, X: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores, per-feature credits and mean path lengths."""
        out, chunk = np.zeros((len(X), len(FEATURES) + 1)), CE.Chunk(self.cuts, X)
        for tree, said in zip(self.trees, self.said):
            out += said[tree.leaf(chunk)]
        out /= len(self.trees)
        return np.power(2.0, -out[:, -1] / self.c_psi), out[:, :-1], out[:, -1]


def _score_matrix(X: np.ndarray, model: dict):
    return Scorer(model).score(X)


def list_array(values: np.ndarray) -> pa.ListArray:
    """(rows, k) numbers as one list a row."""
    ends = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.ascontiguousarray(values).ravel()))


def broadcast_model(spark: SparkSession, model: dict):
    """One broadcast per loaded model, reused by every call (a stream scoring
    each micro-batch must not ship a new copy per batch)."""
    if "_broadcast" not in model:
        model["_broadcast"] = spark.sparkContext.broadcast(dict(model))
    return model["_broadcast"]


def feature_matrix(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    if not batch.num_rows:
        return np.zeros((0, len(columns)))
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns], axis=1)


def score_columns(df: DataFrame) -> DataFrame:
    return df.select("*", *[e.alias(f"_f_{n}") for n, e in feature_columns()])


def score(tx: DataFrame, nodes: DataFrame | dict, threshold: float | None = None,
          model_version: str = "iforest-v1", with_credits: bool = False) -> DataFrame:
    """M2 + M3: every input row plus ``fraud_score``, ``is_anomaly``,
    ``anomaly_threshold``, ``top_feature_1..3``, ``model_version``,
    ``processed_at`` (and ``path_deficit``/``credits`` with
    ``with_credits``)."""
    model = nodes if isinstance(nodes, dict) else load_model(nodes)
    bc = broadcast_model(tx.sparkSession, model)
    staged = score_columns(spread(tx))
    fcols = [f"_f_{n}" for n in FEATURES]
    out_fields = [T.StructField("fraud_score", T.DoubleType(), True),
                  T.StructField("top_feature_1", T.StringType(), True),
                  T.StructField("top_feature_2", T.StringType(), True),
                  T.StructField("top_feature_3", T.StringType(), True),
                  T.StructField("path_deficit", T.DoubleType(), True),
                  T.StructField("credits", T.ArrayType(T.DoubleType()), True)]
    keep = [c for c in staged.columns if c not in fcols]
    schema = T.StructType([staged.schema[c] for c in keep] + out_fields)
    names = pa.array(FEATURES)

    def run(batches):
        scorer = Scorer(bc.value)
        for held in CE.in_chunks(batches):
            whole = scorer.score(np.concatenate([feature_matrix(b, fcols) for b in held]))
            ends = np.cumsum([b.num_rows for b in held])
            for b, s, cr, mean_h in zip(held, *(np.split(x, ends) for x in whole)):
                order = np.argsort(-cr, axis=1, kind="stable")[:, :3]
                arrays = [*(b.column(c) for c in keep), pa.array(s), *(names.take(pa.array(order[:, k])) for k in range(3)),
                          pa.array(scorer.c_psi - mean_h), list_array(cr)]
                yield pa.RecordBatch.from_arrays(arrays, names=keep + [f.name for f in out_fields])

    scored = staged.mapInArrow(run, schema)
    thr = F.lit(threshold) if threshold is not None else F.lit(None).cast("double")
    scored = (scored.withColumn("anomaly_threshold", thr.cast("double"))
              .withColumn("is_anomaly", F.col("fraud_score") >= F.col("anomaly_threshold"))
              .withColumn("model_version", F.lit(model_version))
              .withColumn("processed_at", F.current_timestamp()))
    if not with_credits:
        scored = scored.drop("path_deficit", "credits")
    return scored


def fit_threshold(train_scores: DataFrame, contamination: float = DEFAULT_CONTAMINATION) -> float | None:
    """Score above which the top ``contamination`` share of training rows lie
    (``percentile_approx``, one number to the driver); None without rows."""
    return train_scores.agg(F.percentile_approx("fraud_score", 1.0 - contamination, 10000)).first()[0]


def score_silver(silver: DataFrame, nodes: DataFrame | None = None,
                 contamination: float = DEFAULT_CONTAMINATION,
                 quality_summary: DataFrame | None = None, **train_kw) -> DataFrame:
    """Train (unless ``nodes`` is given), fit the threshold on the training
    rows, and score every silver row.  With ``quality_summary`` (the output of
    ``expectations.summarise``) training is refused when the pass-rate gate
    fails (G2: a failing suite blocks retraining)."""
    if quality_summary is not None and nodes is None:
        from ledgerlake.operators.expectations import passes_gate
        if not passes_gate(quality_summary):
            raise RuntimeError("quality gate failed: retraining blocked")
    train = silver.filter(F.col("dq_passed") == F.lit(True))
    n = train.count()
    if nodes is None:
        nodes = train_forest(silver, n_rows=n, **train_kw)
    model = load_model(nodes)            # one training job; bounded collect
    version = "iforest-t{}-psi{}".format(
        train_kw.get("n_trees", DEFAULT_TREES), train_kw.get("sample_size", DEFAULT_SAMPLE))
    # every row is scored once and kept in the shared folder; the threshold is a
    # quantile of all training scores, whatever their number
    checkpoint_dir(silver.sparkSession)
    scored = score(silver, model, model_version=version).checkpoint()
    thr = fit_threshold(scored.filter(F.col("dq_passed") == F.lit(True)), contamination)
    return (scored.withColumn("anomaly_threshold", F.lit(thr).cast("double"))
            .withColumn("is_anomaly", F.col("fraud_score") >= F.col("anomaly_threshold")))


def fraud_signals(scored: DataFrame) -> DataFrame:
    """K8 row shape (``fraud_signals``): amount as decimal(12,2)."""
    return scored.select(
        "event_id", "event_timestamp", "user_id", "merchant_id", "merchant_category",
        F.col("amount").try_cast("decimal(12,2)").alias("amount"), "currency", "country_code",
        "fraud_score", "is_anomaly", "anomaly_threshold", "top_feature_1", "top_feature_2",
        "top_feature_3", "model_version", "processed_at")


def write_signals(scored: DataFrame, path: str, files: int | None = None) -> None:
    """K8: the stored scored-records table that N4-N6 read, laid out for them.

    Rows are dealt by range of (user, time), so a user lies in one file, or in a few
    neighbouring ones if they hold many rows, and their Parquet footers and Bloom
    filters rule the others out (the index on user).  The flagged rows stand once
    more in ``<path>_anomalies`` (the partial index): about the contamination share
    of the table.  ``files`` bounds the number of ranges, by default that of
    shuffle partitions."""
    rows = fraud_signals(scored).withColumn("event_date", F.to_date("event_timestamp"))
    ranges = ["user_id", "event_timestamp"]
    dealt = rows.repartitionByRange(files, *ranges) if files else rows.repartitionByRange(*ranges)
    (dealt.sortWithinPartitions(*ranges).write.mode("overwrite")
     .option("parquet.bloom.filter.enabled#user_id", "true").parquet(path))
    stored = scored.sparkSession.read.schema(rows.schema).parquet(path)
    (stored.filter(F.col("is_anomaly")).repartitionByRange("event_timestamp").sortWithinPartitions("event_timestamp")
     .write.mode("overwrite").parquet(f"{path}_anomalies"))
