"""Quality classifier: held-out accuracy, defined results, bounded sample."""

import zlib

import numpy as np
import pyarrow as pa

from ledgerlake.llm import quality as Q

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    rows = Q.digest(docs, labels).collect()
    assert len(rows) == docs.count()
    known = {r.doc_id: r.quality for r in labels.collect()}
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    assert np.mean([p == y for p, y in held]) >= 0.95 and len(held) > 50


def test_scores_do_not_depend_on_the_batch():
    texts = ["a b c. D e", "X!! Y!! Z!!", "", None, "q " * 4000] * 8
    y = np.array([1, 0, 1, 1, 0] * 8)
    model = Q.train(pa.array(texts), y)
    folded, index = model.folded(), Q.index_vectors()
    whole = model.scores(pa.array(texts), folded, index)
    alone = np.concatenate([model.scores(pa.array([t], pa.string()), folded, index) for t in texts])
    assert np.allclose(whole, alone, atol=1e-6)
    assert whole[2] == whole[3] and (whole[y == 1] > whole[y == 0].max()).all()
    assert (index != 0).sum(1).max() <= Q.NONZERO


def test_vectors_equal_a_plain_loop():
    texts = pa.array(["a b a c", "c b", "", "d"])
    index = Q.index_vectors()
    w, s, first = Q.keys_of(texts)
    total = np.zeros((len(index), Q.DIMS))
    for d in range(4):
        for i in range(first[d], first[d + 1]):
            for j in range(max(first[d], i - Q.REACH), min(first[d + 1], i + Q.REACH + 1)):
                if i != j:
                    total[w[i]] += index[w[j]] + index[s[j]].astype(int)
                    total[s[i]] += index[w[j]] + index[s[j]].astype(int)
    length = np.sqrt((total ** 2).sum(1, keepdims=True))
    want = total / np.maximum(length, 1) + index / np.sqrt(Q.NONZERO)
    assert np.allclose(Q.word_vectors(w, s, first, index), want, atol=1e-5)


def test_defined_results(spark):
    docs = spark.createDataFrame([(5, None, "k", 1.0), (5, None, "k", 1.0), (6, "", "k", 2.0), (None, "x y", "k", 3.0)],
                                 "doc_id long, text string, keys string, quality_score double")
    none = spark.createDataFrame([(1, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    rows = Q.digest(docs, none).collect()
    assert len(rows) == 4 and {r.score for r in rows} == {0.5}
    assert Q.accepted(docs, none).columns == docs.columns
    assert Q.digest(docs.limit(0), none).count() == 0


def test_sample_is_bounded_and_skips_held_out_rows(spark, monkeypatch):
    monkeypatch.setattr(Q, "SAMPLE_ROWS", 20)
    ids = list(range(100))
    docs = spark.createDataFrame([(i, f"t{i}" + "z" * (30_000 if i == 3 else 0)) for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in ids] + [(7, 0, 0)], "doc_id long, quality int, toxic int")
    taken, quality = Q.sample_ids(docs, labels)
    assert 15 <= len(taken) <= 20 and len(taken) == len(quality)
    for i, y in zip(taken, quality):
        assert zlib.crc32(str(i).encode()) % 5 and y == (1 if i == 7 else i % 2)
    # pooled in the tasks as on the driver
    vectors = np.random.default_rng(1).random((Q.WORD_KEYS + Q.SHAPE_KEYS, Q.DIMS)).astype(np.float32)
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = Q.pooled(pa.array([texts[i] for i in taken]), vectors)
    assert np.allclose(Q.sample_features(docs, taken, vectors), want, atol=1e-5)


def test_word_vectors_cover_all_documents_and_all_lengths(spark, monkeypatch):
    rows = [(i, ("good words here " if i % 2 else "bad!! bad!! ") * 4) for i in range(40)]
    rows += [(100, "unlabelled rare neighbour"), (None, "no id, rare too"), (7, None), (101, "q " * 300_000 + "end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)] + [(101, 0, 0), (102, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    want = Q.word_vectors(*Q.keys_of(pa.array([t for _, t in rows], pa.string())), Q.index_vectors())
    monkeypatch.setattr(Q, "held_out", lambda c: Q.F.lit(False))
    seen, features = [], Q.sample_features
    monkeypatch.setattr(Q, "sample_features", lambda docs, ids, v: seen.append(ids) or features(docs, ids, v))
    assert np.allclose(Q.fit(docs, labels).vectors, want, atol=1e-6)
    assert 101 in seen[-1] and len(seen[-1]) == 41              # long rows are learnt from
    monkeypatch.setattr(Q, "SAMPLE_BYTES", 1000)
    Q.fit(docs, labels)
    size = {i: len(t or "") for i, t in rows}
    assert 15 <= len(seen[-1]) <= 21 and sum(size[i] for i in seen[-1]) <= 1000


def test_sums_travel_in_as_few_bytes_as_they_need():
    for most, size in ((0, 1), (127, 1), (128, 2), (40_000, 4), (1 << 40, 8)):
        for sign in (1, -1):
            sums = np.array([[0, sign * most], [1, -1]], np.int64) if most else np.zeros((2, 2), np.int64)
            got = Q.narrow(sums)
            assert got.dtype.itemsize == size and (got == sums).all()
    assert Q.narrow(np.zeros((0, 2), np.int64)).shape == (0, 2)
