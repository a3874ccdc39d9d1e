"""Jaccard join: classes equal brute force on small tables of every kind."""

import random
import re

import numpy as np
import pytest

from ledgerlake.llm import common, ngram_join as J

SEP = re.compile(r"[\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = [x for x in SEP.split(low) if x]
    if not w:
        return frozenset()
    return frozenset(" ".join(w[i:i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, (a, s) in enumerate(sets):
        for b, t in sets[:k]:
            if s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in root}


def corpus(seed):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]

    def text(n):
        return [r.choice(vocab) for _ in range(n)]

    hot = text(40)
    rows = [(900, None), (901, ""), (902, " \n\t "), (903, "A b"), (904, "a B"), (905, "a b c d e"), (906, "É b c d e"),
            (907, "é b c d e"), (None, "a b"), (None, None), (908, "x " * 30000), (909, "x " * 20), (910, "a b")]
    for k in range(25):
        base = text(r.randrange(5, 120))
        if k % 3 == 0:
            base = hot + base
        for c in range(r.randrange(1, 9)):
            near = list(base)
            for _ in range(r.randrange(6)):
                near[r.randrange(len(near))] = r.choice(vocab)
            if r.random() < 0.3:
                near = near[: max(1, int(len(near) * r.uniform(0.7, 1)))]
            rows.append((len(rows) * 7 % 1009 + 2000, " ".join(near)))
            if r.random() < 0.3:
                rows.append((len(rows) * 7 % 1009 + 4000, " ".join(near).upper()))
    chain = text(60)                          # neighbours link, ends do not
    for k in range(12):
        rows.append((6000 + k, " ".join(chain[k * 2:] + text(k * 2))))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,piece", [(1, 256), (2, 3)])
def test_classes_equal_brute_force(spark, monkeypatch, seed, piece):
    monkeypatch.setattr(J, "PIECE", piece)
    rows = corpus(seed)
    df = spark.createDataFrame([(*x, "c", 1) for x in rows], "doc_id long, text string, grp string, n int")
    got = J.jaccard_classes(df).collect()
    want, sizes = brute(rows), dict(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.component_id is None for r in got if r.doc_id is None)
    assert all(r.n_shingles == len(shingles(sizes[r.doc_id])) for r in got if r.doc_id is not None)
    kept = J.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({*want.values()})


def test_repeated_rows_shuffled_lookups_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(J, "BROADCAST_IDS", 0)
    rows = [(1, "a b c d e f g h"), (2, "a b c d e f g h i"), (1, "a b c d e f g h"), (3, "q r s t u v w x y z"), (3, None)] * 3
    got = {(r.doc_id, r.n_shingles): r.component_id for r in J.jaccard_classes(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {(1, 4): 1, (2, 5): 1, (3, 6): 3, (3, 0): 3}
    assert J.jaccard_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_components_of_paths_stars_and_cycles(spark):
    r = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(200, k) for k in range(201, 260)] + [(5, 9), (9, 7), (7, 5), (4, 4)]
    links += [(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)]
    r.shuffle(links)
    got = {x.id: x.component for x in common.components(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])

    for a, b in links:
        if a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {i: find(i) for i in list(root)}


def test_one_of_each_keeps_one_row_of_each_group(spark):
    a, b, c = "a b c d e f g h", "q r s t u v w x y z", "k l m n o p k l m"
    rows = [(5, a, "s"), (5, a, "s"), (5, a, "t"), (9, a + " i", "s"),        # repeated rows, and a near copy
            (None, b, "s"), (None, b, "s"), (None, b + " !", "s"),           # copies with a null id only
            (3, c, "s"), (9, c, "s"),                                        # one id, two texts: only one is a copy
            (None, a, "s"), (9, "one more text of its own", "s"), (7, None, "s"), (8, "", "s"), (None, None, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string")
    out = J.one_of_each(df)
    assert out.columns == df.columns
    got = [tuple(r) for r in out.collect()]
    assert [r[0] for r in got if r[1] and r[1].startswith(a)] == [5]
    assert [r[0] for r in got if r[1] and r[1].startswith(b)] == [None]
    assert [r[0] for r in got if r[1] == c] == [3]
    assert sorted((r for r in got if r[1] is None or r[1] in ("", "one more text of its own")), key=repr) == sorted(rows[-4:], key=repr)
    assert len(got) == 7 and {*got} <= {*rows}
    assert J.one_of_each(df.limit(0)).count() == 0


def test_rows_are_named_null_safely_and_names_never_collide(spark, monkeypatch):
    text = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    rows = [(5, None, text), (5, text, None), (5, text, text), (5, None, text), (None, None, None), (6, "", ""), (6, None, ""), (6, "", None)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    names = J.row_names(df).collect()
    assert len({r._row for r in names}) == len({(r.doc_id, r.lang, r.text) for r in names}) == 7
    # the two rows with the text are one group; rows without one stay, each by itself
    kept = sorted(map(tuple, J.one_of_each(df).collect()), key=str)
    assert sum(r[2] == text for r in kept) == 1 and len(kept) == 6 and (5, text, None) in kept
    # names that clash by chance are made anew
    real, calls = J.F.xxhash64, []

    def poor(*cols):
        calls.append(1)
        return J.F.lit(7).cast("long") if len(calls) == 1 else real(*cols)
    monkeypatch.setattr(J.F, "xxhash64", poor)
    again = J.row_names(df).collect()
    assert len({r._row for r in again}) == 7 and {r._row for r in again if r.lang is None and r.text == text}.__len__() == 1


def test_bitmaps_rule_out_no_link_and_most_other_pairs(spark):
    r = np.random.default_rng(5)
    rows, want = [], []
    for k in range(400):
        n = int(r.integers(1, 400))
        a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[int(len(a) * r.uniform(0, 0.3)) * (k % 2):],
                                      r.integers(0, 1 << 63, int(len(a) * r.uniform(0, 0.3)), dtype=np.uint64)]))
        if k % 4 == 3:
            b = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
        both = len(np.intersect1d(a, b))
        want.append((4 * both >= 3 * (len(a) + len(b) - both), k % 4 == 3 and n > 30))
        rows.append((k, len(a), J.parities(a).tolist(), len(b), J.parities(b).tolist()))
    df = spark.createDataFrame(rows, "k int, n long, x array<long>, m long, y array<long>")
    kept = {q.k for q in df.where(J.may_reach(*map(J.F.col, ("n", "x", "m", "y")))).collect()}
    assert sum(w for w, _ in want) > 60 and {len(q[2]) != len(q[4]) for q in rows} == {True, False}
    assert all(k in kept for k, (linked, _) in enumerate(want) if linked)
    assert not any(k in kept for k, (_, strange) in enumerate(want) if strange)


def test_crowded_counters_still_tell_frequent_tokens(spark, monkeypatch):
    # every counter holds some 2,500 rare tokens; one more token is in every document
    monkeypatch.setattr(J, "SKETCH", 1 << 6)
    r = random.Random(8)
    texts = ["a b c d e"] + ["a b c d e " + " ".join(str(r.random()) for _ in range(400)) for _ in range(400)]
    classes = J.sketch(spark.createDataFrame([(t,) for t in texts], "text string").repartition(2))
    token = J.shingle_sets(J.pa.array(texts[:1]))[0][0]
    assert classes[int(token) % J.SKETCH] == classes.max() > np.median(classes)


def test_steps_between_write_no_checkpoint_files(spark):
    """Each file of a checkpoint starts a process from the executor: with many shuffle
    partitions there were two for each partition of each step, of hundreds of steps."""
    import os
    from urllib.parse import urlparse

    from ledgerlake.llm import common

    root = urlparse(common.checkpoint_dir(spark)).path

    def files():
        return sum(len(names) for at, _, names in os.walk(root) if "/rdd-" in at)

    before = files()
    links = [(i, i + 1) for i in range(40)]
    assert {x.component for x in common.components(spark.createDataFrame(links, "a long, b long")).collect()} == {0}
    assert files() == before


def test_tiny_splits_are_packed(spark, scratch):
    from ledgerlake.llm import common

    most = 2 * spark.sparkContext.defaultParallelism
    spark.range(5000).repartition(3 * most).write.parquet(scratch)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        df = spark.read.parquet(scratch)
        got = common.packed(df)
        assert got.rdd.getNumPartitions() <= most < df.rdd.getNumPartitions()
        assert sorted(r.id for r in got.collect()) == list(range(5000))
        # a table that is worth its partitions keeps them
        assert common.packed(df, 1 << 40).rdd.getNumPartitions() == df.rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
