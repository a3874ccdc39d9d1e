"""Quality classifier: random-indexing word vectors, pooled per document, and a
two-layer network with temperature-calibrated probabilities.

Every word has two keys, a hash of itself and one of its shape (letters, capitals,
digits and other characters, runs collapsed).  A key's index vector is a fixed
sparse random vector; its word vector gathers the index vectors of its
neighbours in all documents.  A document is the mean of its words' vectors,
the length of its mean index vector and the share of words that repeat the one
before (both grow with repetition), and its log word count.  The network is
trained on a bounded sample of labelled rows of all lengths (``SAMPLE_ROWS`` rows
and ``SAMPLE_BYTES`` bytes together, in the order of a hash of doc_id); one part of it fits the temperature.  Scoring reads whole texts.

Defined results: null and empty texts have zero vectors and get the network's
score for them; without labelled rows of both classes every score is 0.5;
labelled twice, a row counts as its larger label; repeated rows are scored each
by themselves; an empty table gives an empty table; only doc_id and text are
read, and other columns pass through ``score`` untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import SMALL_BLOCK, Words, drop_caches, give_back, mix, slices, span_hashes

#: bound of the network's training sample: rows, and bytes of text together
SAMPLE_ROWS, SAMPLE_BYTES = 4000, 1 << 25
DIMS, NONZERO, HIDDEN = 32, 4, 16
WORD_KEYS, SHAPE_KEYS = 1 << 16, 1 << 12
#: blocks of keys in which the tasks add up word vectors
KEY_PARTS = 64
REACH = 2
THRESHOLD = 0.3

_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")
_SHAPE[128:] = ord("a")


def index_vectors() -> np.ndarray:
    """(keys, DIMS) int8: NONZERO entries of +1 or -1 from a hash of key and entry."""
    keys = WORD_KEYS + SHAPE_KEYS
    out = np.zeros((keys, DIMS), np.int8)
    at = np.arange(keys)
    for k in range(NONZERO):
        h = mix(at.astype(np.uint64), 100 + k)
        out[at, (h >> np.uint64(8)) % np.uint64(DIMS)] = np.where(h & np.uint64(1), 1, -1)
    return out


def keys_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word keys, shape keys, first word of each text)."""
    w = Words(texts, lower=False)
    shape = _SHAPE[w.data]
    keep = np.ones(len(shape), bool)
    keep[1:] = shape[1:] != shape[:-1]
    keep[w.start] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    shapes = span_hashes(shape[keep], place[w.start], place[w.end])
    return ((w.hash % np.uint64(WORD_KEYS)).astype(np.int64),
            (WORD_KEYS + shapes % np.uint64(SHAPE_KEYS)).astype(np.int64), w.first)


def _sums(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of rows over each text; zero for texts without words."""
    out = np.zeros((len(first) - 1, rows.shape[1]), np.float32)
    full = first[1:] > first[:-1]
    if full.any():
        out[full] = np.add.reduceat(rows, first[:-1][full], axis=0)
    return out


@dataclass
class Model:
    vectors: np.ndarray             # (keys, DIMS) word vectors
    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def folded(self) -> np.ndarray:
        """The first layer applied to each key's vector: pooling commutes with it."""
        return (self.vectors @ (self.w1[:DIMS] / self.scale[:DIMS, None])).astype(np.float32)

    def scores(self, texts: pa.Array, folded: np.ndarray, index: np.ndarray) -> np.ndarray:
        words, shapes, first = keys_of(texts)
        n = np.maximum(np.diff(first), 1)[:, None].astype(np.float32)
        pooled = np.zeros((len(first) - 1, HIDDEN), np.float32)
        for keys in (words, shapes):
            pooled += _sums(folded[keys], first) / n
        extra = (extras(words, first, index) - self.mean[DIMS:]) / self.scale[DIMS:]
        hidden = np.tanh(pooled - (self.mean[:DIMS] / self.scale[:DIMS]) @ self.w1[:DIMS]
                         + extra @ self.w1[DIMS:] + self.b1)
        z = (hidden @ self.w2 + self.b2).astype(np.float64)
        return 1.0 / (1.0 + np.exp(-z / self.temperature))


def extras(words: np.ndarray, first: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Of each text: length of the mean index vector, log word count, and the
    share of words that repeat the one before (neighbours with one index vector)."""
    count = np.diff(first).astype(np.float32)
    again = np.zeros(len(words), np.float32)
    again[1:] = words[1:] == words[:-1]
    again[first[:-1][count > 0]] = 0
    repeats = _sums(again[:, None], first)[:, 0] / np.maximum(count, 1)
    mean = _sums(index[words].astype(np.float32), first) / np.maximum(count, 1)[:, None]
    return np.stack([np.log(1e-3 + np.sqrt((mean ** 2).sum(1))), np.log1p(count), repeats], axis=1)


def add_neighbours(total: np.ndarray, words: np.ndarray, shapes: np.ndarray, first: np.ndarray, index: np.ndarray) -> None:
    """Adds each key's neighbours' index vectors in these texts to ``total`` (exact integers)."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    block = 1 << 14
    for at in range(0, len(words), block):
        lo, hi = max(0, at - REACH), min(len(words), at + block + REACH)
        own = index[words[lo:hi]] + index[shapes[lo:hi]]
        near = np.zeros_like(own)               # at most 4 * REACH in size
        for k in range(1, REACH + 1):
            same = (text[lo:hi][k:] == text[lo:hi][:-k])[:, None]
            near[k:] += own[:-k] * same
            near[:-k] += own[k:] * same
        part = near[at - lo:min(at + block, len(words)) - lo].astype(np.int32)
        for keys in (words[at:at + block], shapes[at:at + block]):
            order = np.argsort(keys, kind="stable")
            found, begin = np.unique(keys[order], return_index=True)
            total[found] += np.add.reduceat(part[order], begin, axis=0)


def _scaled(total: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Word vectors: each key's normalised sum, plus its own index vector."""
    length = np.sqrt((total.astype(np.float64) ** 2).sum(1, keepdims=True))
    return (total / np.maximum(length, 1) + index / np.sqrt(NONZERO)).astype(np.float32)


def word_vectors(words: np.ndarray, shapes: np.ndarray, first: np.ndarray, index: np.ndarray) -> np.ndarray:
    """Each key's normalised sum of its neighbours' index vectors, plus its own."""
    total = np.zeros(index.shape, np.int64)
    add_neighbours(total, words, shapes, first, index)
    return _scaled(total, index)


def narrow(sums: np.ndarray) -> np.ndarray:
    """The same integers in as few bytes as the largest needs."""
    most = int(np.abs(sums).max(initial=0))
    return sums.astype(next(k for k in (np.int8, np.int16, np.int32, np.int64) if most <= np.iinfo(k).max))


def corpus_vectors(docs: DataFrame) -> np.ndarray:
    """The word vectors of all documents: a table of fixed size (18 MB of sums),
    added up by blocks of keys in the tasks."""
    width = (WORD_KEYS + SHAPE_KEYS) // KEY_PARTS
    kind = "part int, salt int, used binary, sums binary"

    def row(part, salt, block):
        used = np.flatnonzero(block.any(1))
        return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "salt": pa.array([salt], pa.int32()),
                                           "used": [used.astype(np.int32).tobytes()], "sums": [narrow(block[used]).tobytes()]})

    def unpack(used, sums):
        at = np.frombuffer(used, np.int32)
        return at, np.frombuffer(sums, f"i{len(sums) // max(1, len(at) * DIMS) or 8}").reshape(-1, DIMS)

    def count(batches):
        drop_caches()
        index = index_vectors()
        total = np.zeros(index.shape, np.int64)
        for b in slices(batches, "text", SMALL_BLOCK):
            add_neighbours(total, *keys_of(b.column(0)), index)
        salt = TaskContext.get().partitionId() % 64
        for p in range(KEY_PARTS):
            yield row(p, salt, total[p * width:(p + 1) * width])
        del total
        give_back()

    def add(batches):                             # sorted: one block at a time
        last, block = None, None
        for b in batches:
            for p, s, used, sums in zip(*(b.column(k).to_pylist() for k in range(4))):
                if (p, s) != last:
                    if last:
                        yield row(last[0], 0, block)
                    last, block = (p, s), np.zeros((width, DIMS), np.int64)
                at, got = unpack(used, sums)
                block[at] += got
        if last:
            yield row(last[0], 0, block)
        give_back()

    parts = docs.select("text").mapInArrow(count, kind)
    for _ in range(2):                            # salted first, then by part
        parts = parts.repartition("part", "salt").sortWithinPartitions("part", "salt").mapInArrow(add, kind)
    index = index_vectors()
    total = np.zeros(index.shape, np.int64)
    for r in parts.collect():                     # KEY_PARTS rows
        at, got = unpack(r.used, r.sums)
        total[r.part * width + at] += got
    return _scaled(total, index)


def both_classes(labels: np.ndarray) -> bool:
    return len(labels) > 1 and labels.min() != labels.max()


def train(texts: pa.Array, labels: np.ndarray) -> Model | None:
    """Fit the word vectors of these texts, the network and its temperature; None
    if a class is missing."""
    if not both_classes(labels):
        return None
    vectors = word_vectors(*keys_of(texts), index_vectors())
    return network(pooled(texts, vectors), labels, vectors)


def pooled(texts: pa.Array, vectors: np.ndarray) -> np.ndarray:
    """(texts, DIMS + 3) features: mean word vectors and ``extras``."""
    index = index_vectors()
    words, shapes, first = keys_of(texts)
    n = np.maximum(np.diff(first), 1)[:, None].astype(np.float32)
    sums, more, step = np.zeros((len(n), DIMS), np.float32), [np.zeros((0, 3), np.float32)], 100
    for at in range(0, len(n), step):
        part = first[at:at + step + 1]
        for keys in (words, shapes):
            sums[at:at + step] += _sums(vectors[keys[part[0]:part[-1]]], part - part[0])
        more.append(extras(words[part[0]:part[-1]], part - part[0], index))
    return np.concatenate([sums / n, np.concatenate(more)], axis=1)


def network(x: np.ndarray, labels: np.ndarray, vectors: np.ndarray, seed: int = 7) -> Model:
    """Fit the network over these features, and its temperature."""
    rng = np.random.default_rng(seed)
    held = rng.random(len(labels)) < 0.2
    if held.all() or not held.any() or labels[~held].min() == labels[~held].max():
        held = np.zeros(len(labels), bool)
    mean, scale = x[~held].mean(0), x[~held].std(0) + 1e-3
    x = (x - mean) / scale
    p = {"w1": rng.normal(0, 0.3, (x.shape[1], HIDDEN)), "b1": np.zeros(HIDDEN),
         "w2": rng.normal(0, 0.3, HIDDEN), "b2": np.zeros(1)}
    m, v = ({k: np.zeros_like(a) for k, a in p.items()} for _ in range(2))
    xt, yt = x[~held].astype(np.float64), labels[~held].astype(np.float64)
    for t in range(1, 401):
        h = np.tanh(xt @ p["w1"] + p["b1"])
        d = (1 / (1 + np.exp(-(h @ p["w2"] + p["b2"]))) - yt) / len(yt)
        dh = np.outer(d, p["w2"]) * (1 - h * h)
        g = {"w1": xt.T @ dh + 1e-4 * p["w1"], "b1": dh.sum(0), "w2": h.T @ d + 1e-4 * p["w2"], "b2": d.sum(keepdims=True)}
        for k in p:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            p[k] -= 0.02 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    on = held if held.any() else ~held
    z = np.tanh(x[on] @ p["w1"] + p["b1"]) @ p["w2"] + p["b2"]
    y = labels[on]

    def loss(temp):
        return np.logaddexp(0, np.where(y == 1, -z, z) / temp).mean()

    temperature = float(min(np.geomspace(0.25, 8, 61), key=loss))
    return Model(vectors.astype(np.float32), mean, scale, p["w1"], p["b1"], p["w2"], float(p["b2"][0]), temperature)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def sample_ids(docs: DataFrame, labels: DataFrame) -> tuple[list[int], np.ndarray]:
    """(ids, labels) of the bounded sample: labelled rows that are not held out, of all
    lengths, in the order of a hash of their id, up to the bounds."""
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    # ids first: the sort then moves ids, not texts; the sample is a bounded broadcast
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    rows = (docs.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size"))
            .join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.max("size").alias("size"), F.max("quality").alias("quality"))
            .where(F.col("size") <= SAMPLE_BYTES).orderBy(F.xxhash64("doc_id"), "doc_id").collect())
    fit_in = int(np.searchsorted(np.cumsum([r["size"] for r in rows]), SAMPLE_BYTES, "right")) if rows else 0
    return [r.doc_id for r in rows[:fit_in]], np.array([r.quality for r in rows[:fit_in]], np.int64)


def sample_features(docs: DataFrame, ids: list[int], vectors: np.ndarray) -> np.ndarray:
    """Features of the sample's rows (an id with several texts: its largest), in the
    order of ``ids``.  Texts stay in the tasks; the driver gets DIMS + 3 numbers a row."""
    spark = docs.sparkSession
    taken = spark.createDataFrame([(i,) for i in ids], T.StructType([docs.schema["doc_id"]]))
    sent = spark.sparkContext.broadcast(vectors)  # fixed size, 9 MB

    def pool(batches):
        drop_caches()
        for b in slices(batches, "text", SMALL_BLOCK):
            x = pooled(b.column(1), sent.value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(list(x), pa.list_(pa.float32()))], names=["doc_id", "x"])

    sample = (docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id").groupBy("doc_id").agg(F.max("text").alias("text"))
              .mapInArrow(pool, T.StructType([docs.schema["doc_id"], T.StructField("x", T.ArrayType(T.FloatType()))])))
    found = {r.doc_id: r.x for r in sample.collect()}
    sent.unpersist()
    return np.array([found[i] for i in ids], np.float32)


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Word vectors from all documents; the network from the bounded sample of
    labelled rows that are not held out."""
    ids, quality = sample_ids(docs, labels)
    if not both_classes(quality):                 # nothing to train, and no pass over the documents
        return None
    vectors = corpus_vectors(docs)
    return network(sample_features(docs, ids, vectors), quality, vectors)


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``quality_score``."""
    kept = [c for c in docs.columns if c != "quality_score"]
    docs = docs.select(*[F.col(f"`{c}`") for c in kept])
    if model is None:
        return docs.withColumn("quality_score", F.lit(0.5))
    sent = docs.sparkSession.sparkContext.broadcast(model)      # fixed size, about 9 MB

    def run(batches):
        drop_caches()
        model = sent.value
        folded, index = model.folded(), index_vectors()
        for b in slices(batches, "text", SMALL_BLOCK):
            s = model.scores(b.column(b.schema.get_field_index("text")), folded, index)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s, pa.float64())], names=[*kept, "quality_score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())]))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted."""
    docs = docs.select("doc_id", "text")
    scored = score(docs, fit(docs, labels)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("quality_score").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    cols = docs.columns
    return (score(docs, fit(docs, labels)).where(F.col("quality_score") >= THRESHOLD)
            .select(*[F.col(f"`{c}`") for c in cols]))
