"""LM scores, license scans and embedding near-dedup against brute force."""

import math
import random
import re
import textwrap
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import embed_dedup as E
from ledgerlake.llm import license_scan as L
from ledgerlake.llm import lm_score as M

# ---- language model -----------------------------------------------------------


def words(t):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", low) if w]


def lm_brute(texts):
    docs = [words(t) for t in texts]
    one = [Counter(d) for d in docs]
    two = [Counter(zip(d, d[1:])) for d in docs]
    all1, all2, n = sum(one, Counter()), sum(two, Counter()), sum(map(len, docs))
    out = []
    for d, o, t in zip(docs, one, two):
        total, rest = 0.0, max(n - len(d), 1)
        for i, w in enumerate(d):
            c = all1[w] - o[w]
            s = (c if c > 0 else 0.4) / rest
            if i:
                pair = (d[i - 1], w)
                cc = all2[pair] - t[pair]
                s = cc / (all1[d[i - 1]] - o[d[i - 1]]) if cc > 0 else 0.4 * s
            total += math.log10(s)
        out.append(total)
    return out


@pytest.mark.parametrize("slice_bytes,keys", [(1 << 24, 1 << 22), (60, 10)])
def test_scores_equal_brute_force(spark, monkeypatch, slice_bytes, keys):
    monkeypatch.setattr(M, "SLICE_BYTES", slice_bytes)
    monkeypatch.setattr(M, "PART_KEYS", keys)
    r = random.Random(4)
    texts = [None, "", " \n", "Solo", "a a a a", "A bé a", "a b " * 2000]
    texts += [" ".join(r.choice("abcdefghij") for _ in range(r.randrange(30))) for _ in range(40)]
    texts += texts[-3:]
    rows = [(i if i != 5 else None, t, "x", 1) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, words string, first int")
    got = {r.doc_id: r for r in M.score(df).collect()}
    want = lm_brute(texts)
    assert len(got) == len(rows)
    for (i, t, *_), s in zip(rows, want):
        assert got[i].score == pytest.approx(s, abs=1e-6) and got[i].n_words == len(words(t))
    assert M.score(df.limit(0)).count() == 0


# ---- licenses -----------------------------------------------------------------

GRANT = L.SENTENCES["apache-grant"]
CASES = {
    1: ("Intro.\nReleased under the MIT License.\nMore", "mit-line", "MIT", ""),
    2: ("RELEASED!! UNDER!! THE!! MIT!! LICENSE.!!\nx", "mit-line", "MIT", ""),
    3: (f"{GRANT}; All rights reserved. {L.SENTENCES['apache-only']}. Unknown here. {L.SENTENCES['apache-asis']}.",
        "apache-grant reserved apache-only apache-asis", "Apache-2.0", "reserved"),
    4: (f"{L.SENTENCES['apache-asis']}. {L.SENTENCES['apache-only']}.", "apache-asis apache-only", "", "apache-asis apache-only"),
    5: ("Licensed under CC BY-NC 4.0.\nLicensed under the Apache License, Version 2.0.\nReleased under the MIT License.",
        "ccbync-line apache-line mit-line", "Apache-2.0,MIT,CC-BY-NC-4.0", ""),
    6: (f"{L.SENTENCES['gpl-free']}. {L.SENTENCES['gpl-hope']}; x", "gpl-free gpl-hope", "GPL-3.0-or-later", ""),
    7: ("word " * 50000 + ".\nAll rights reserved.\nAll rights reserved.", "reserved reserved", "", "reserved reserved"),
}


def test_license_rules(spark):
    rows = [(k, c[0], "s") for k, c in CASES.items()]
    rows += [(90, None, "s"), (91, "", "s"), (92, "not released under the MIT License at all.", "s"), rows[0]]
    df = spark.createDataFrame(rows, "doc_id long, text string, sentence string")
    got = {r.doc_id: (r.sentences, r.licenses, r.rest) for r in L.scan(df).collect()}
    assert got == {k: c[1:] for k, c in CASES.items()}
    assert L.scan(df.limit(0)).count() == 0
    assert len({L.SENTENCES[k] for k in L.SENTENCES}) == len(L.SENTENCES)
    assert all(i in L.SENTENCES for _, ids in L.RULES for i in ids)


def wrapped(sentence, leader="", width=60):
    return "\n".join(leader + x for x in textwrap.wrap(sentence, width, break_long_words=False, break_on_hyphens=False))


S = L.SENTENCES
WRAPPED = {
    1: (f"MIT License\n\nCopyright (c) 2020 X\n\n{wrapped(S['mit-grant'])}\n\n{wrapped(S['mit-notice'])}.\n\nTHE SOFTWARE",
        "mit-grant mit-notice", "MIT", ""),
    2: (f"/*\n * Copyright X\n{wrapped(S['isc-grant'], ' * ')}.\n *\n */", "isc-grant", "ISC", ""),
    3: (f"{wrapped(S['gpl-free'], '# ')}.\r\n#\r\n{wrapped(S['gpl-hope'], ';; ', 30)};\n;; without", "gpl-free gpl-hope",
        "GPL-3.0-or-later", ""),
    4: (f"// Licensed under the Apache License, Version 2.0\n// (the \"License\");\n{wrapped(S['apache-only'], '// ', 20)}.\n//\n"
        f"{wrapped(S['apache-asis'], '// ')}.\n", "apache-grant apache-only apache-asis", "Apache-2.0", ""),
    5: ("code\nReleased under\nthe MIT License\nAll rights reserved\nmore", "mit-line reserved", "MIT", "reserved"),
    6: (f"Released under{' ' * 2000}the{'-=' * 1000} MIT License.", "mit-line", "MIT", ""),
}


def test_wrapped_and_padded_sentences_are_found(spark):
    rows = [(k, c[0], "s") for k, c in WRAPPED.items()] + [(90, "Released under\n\nthe MIT License", "s"),
                                                          (91, "Released under the\nMIT License of old", "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lines string")
    got = {r.doc_id: (r.sentences, r.licenses, r.rest) for r in L.scan(df).collect()}
    assert got == {k: c[1:] for k, c in WRAPPED.items()}
    two = spark.createDataFrame([(None, S["mit-line"]), (None, S["ccby-line"]), (None, wrapped(S["apache-grant"], "# ", 30))],
                                "doc_id long, text string")
    assert [r.licenses for r in L.scan(two).collect()] == ["Apache-2.0,MIT,CC-BY-4.0"]


# ---- embeddings ----------------------------------------------------------------


def groups(rows):
    ok = {}
    for i, v in rows:
        x = np.array([np.nan if a is None else a for a in v or []], np.float64)
        if i is not None and len(x) and np.isfinite(x).all() and x.any():
            ok.setdefault(i, []).append(x / np.abs(x).max() / np.sqrt(((x / np.abs(x).max()) ** 2).sum()))
    flat = [(i, x) for i, xs in ok.items() for x in xs]
    links, root = Counter(), {i: i for i, _ in rows if i is not None}

    def find(x):
        return x if root[x] == x else find(root[x])

    for k, (i, x) in enumerate(flat):
        for m, (j, y) in enumerate(flat):
            if k != m and len(x) == len(y) and x @ y >= 0.9:
                links[k] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (links[k], find(i)) for k, (i, _) in enumerate(flat)}, {i: find(i) for i in root}


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 50)
    r = np.random.default_rng(2)
    base = r.normal(size=(60, 16))
    rows = [(i, [float(x) for x in base[i % 60] + r.normal(scale=0.25 if i % 4 else 0.05, size=16)]) for i in range(400)]
    big = base[0] + r.normal(scale=0.02, size=(150, 16))
    rows += [(1000 + i, [float(x) for x in v]) for i, v in enumerate(big)]
    rows += [(2000 + i, rows[3][1]) for i in range(30)]
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [1.0, None] + [0.0] * 14), (3004, [float("nan")] * 16),
             (3005, [float("inf")] + [1.0] * 15), (3006, [1.0, 2.0]), (3007, [2.0, 4.0]), (3008, [1e30] + [0.0] * 15),
             (3009, [1e-30] + [0.0] * 15), (None, rows[0][1])]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, rep string")
    got = E.near_duplicates(df).collect()
    exact, comps = groups(rows)
    assert len(got) == len(rows)
    found = true = 0
    for g in got:
        if g.vec_id is None:
            assert (g.n_links, g.component_id, g.kept) == (0, None, False)
            continue
        assert g.component_id == comps[g.vec_id] and g.kept == (g.vec_id == g.component_id)
        want = exact.get(g.vec_id, (0, None))[0]
        assert g.n_links <= want
        found, true = found + g.n_links, true + want
    assert found >= 0.99 * true > 1000
    assert E.near_duplicates(df.limit(0)).count() == 0


def test_audit_weighs_vectors_not_links_and_ends_exactly(spark, monkeypatch):
    true = {i: 5000 for i in range(90)} | {100 + i: 1 for i in range(10)}
    assert E.reached(true, true) and not E.reached(true, {i: n for i, n in true.items() if n > 1})
    r = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(r.normal(size=(300, 16)))]
    rows += [(1000 + i, [x * (2 + i) for x in rows[i][1][:-1]] + [0.0]) for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    monkeypatch.setattr(E, "RECALL", 2.0)             # no beam passes
    monkeypatch.setattr(E, "BEAM", E.SHARD_ROWS // 2)
    exact, comps = groups([(x.vec_id, x.embedding) for x in df.collect()])
    got = E.near_duplicates(df).collect()
    assert {x.vec_id: (x.n_links, x.component_id) for x in got} == exact and sum(n for n, _ in exact.values()) > 4


def test_forest_spans_the_links():
    a, b = np.array([5, 7, 9, 1]), np.array([7, 9, 5, 2])
    ids, roots = E._roots(a, b)
    assert {*zip(ids.tolist(), roots.tolist())} == {(7, 5), (9, 5), (2, 1)}


def test_rules_take_their_sentences_in_order_from_the_left():
    def brute(ids, rules):
        """Matches of a rule do not interleave: the next one begins behind the last."""
        found, rest = [], list(ids)
        for name, steps in rules:
            gone, begin = set(), 0
            while True:
                at, taken = begin, []
                for step in steps:
                    at = next((k for k in range(at, len(rest)) if rest[k] == step), None)
                    if at is None:
                        break
                    taken.append(at)
                    at += 1
                if len(taken) < len(steps):
                    break
                gone |= set(taken)
                begin = taken[-1] + 1
                found += [] if name in found else [name]
            rest = [x for k, x in enumerate(rest) if k not in gone]
        return found, rest

    r = random.Random(7)
    rules = [("X", ("a", "b", "c")), ("Y", ("a", "a")), ("X", ("a",)), ("Z", ("b", "d")), ("W", ("d",))]
    for _ in range(2000):
        ids = [r.choice("abcde") for _ in range(r.randrange(9))]
        assert L.matched(ids, rules) == brute(ids, rules), ids


def test_a_text_of_very_many_sentences_returns(spark):
    n = 10_000
    text = "Released under the MIT License. Something else. " * n + "All rights reserved."
    row = L.scan(spark.createDataFrame([(1, text), (2, "SPDX-License-Identifier: MPL-2.0\n"), (3, None)], "doc_id long, text string")).collect()
    got = {r.doc_id: r for r in row}
    assert set(got) == {1, 2} and got[2].licenses == "MPL-2.0"
    assert got[1].licenses == "MIT" and got[1].rest == "reserved" and got[1].sentences.count("mit-line") == n
