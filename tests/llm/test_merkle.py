"""Merkle manifest against a plain tree."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import merkle as M

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(r, text):
    return h(*map(field, (r[0], r[1], r[2], r[3], text)))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    out = []
    for nodes in tree[:-1]:
        first = i - i % 3
        out.append((nodes[first:i], nodes[i + 1:first + 3]))
        i //= 3
    return out


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r, r[4])))
    trees = {s: levels([leaf(r, r[4]) for r in by[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            steps = path(trees[s], i) + path(top, k)
            text = r[4]
            if text is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(r, text)
            for a, b in steps:
                node = h(*a, node, *b)
            out.append((r[0], leaf(r, r[4]), trees[s][-1][0], top[-1][0], h(*[x for a, b in steps for x in a + b]), node, node == top[-1][0]))
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "other", 5) for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, leaf string, place int")


def check(spark, rows):
    got = M.manifest(frame(spark, rows))
    assert got.columns == COLUMNS
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)


def test_small_groups_nulls_ties_and_repeated_rows(spark):
    r = random.Random(1)
    rows = [(i, "a", "en", 3, f"t{i}\nx") for i in range(10)] + [(5, "lone", None, None, None)]
    rows += [(i * 64 + 63, "é", "de", None, "") for i in range(-4, 5)] + [(-2 ** 63, "é", "x", 1, "\n"), (2 ** 63 - 1, "é", "x", 1, "\n")]
    rows += [(None, None, None, None, None)] + [(None, "n", "en", 1, f"{i}\n") for i in range(5)] + [(None, "n", "en", 1, "1\n")]
    rows += [(7, "twice", "en", 1, r.choice("abc")) for _ in range(20)] + [(8, "twice", "en", 1, "z" * 40_000)] + [(6, "twice", "en", 1, "y")]
    rows += [(3, "", "en", 1, "\n\n"), (4, "a|b", "en", 1, "|")]
    r.shuffle(rows)
    check(spark, rows)
    check(spark, rows[:1])
    assert M.manifest(frame(spark, rows).limit(0)).count() == 0


def test_groups_of_several_blocks(spark):
    r = random.Random(2)
    ids = r.sample(range(0, 10 ** 7), M.BLOCK * 2 + 5)
    rows = [(i, "big", "en", i % 9, f"x\n{i}" if i % 3 else f"{i}") for i in ids]
    rows += [(i, f"s{i % 11}", "fr", 1, str(i)) for i in range(300)]
    check(spark, rows)


def test_places_are_the_ranks_of_the_ids(spark, monkeypatch):
    monkeypatch.setattr(M, "DIRECTORY_BITS", 9)          # four levels
    r = random.Random(4)
    ids = [r.randrange(-2 ** 40, 2 ** 40) if i % 2 else r.randrange(3000) for i in range(1500)]
    df = spark.createDataFrame([(str(i % 3), x) for i, x in enumerate(ids)], "group string, doc_id long")
    leaves = df.withColumn("leaf", F.col("doc_id").cast("string")).withColumn("tampered", F.col("leaf"))
    got = {}
    for row in M.placed_leaves(leaves).collect():
        got.setdefault(row.group, []).append((row.place, row.doc_id))
    for g in "012":
        assert sorted(got[g]) == list(enumerate(sorted(x for i, x in enumerate(ids) if str(i % 3) == g)))


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_documents(spark, sf):
    rows = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted(map(tuple, M.manifest(spark.read.parquet(f"{sf}/documents.parquet")).collect()), key=str)
    assert got == brute(rows) and any(r[-1] for r in got) and not all(r[-1] for r in got)
