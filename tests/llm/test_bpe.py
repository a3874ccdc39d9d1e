"""Byte-level BPE against the tokenizer library, and exact round trips."""

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from ledgerlake.llm import bpe

RANKS = bpe.ranks_bytes(public_tokenizers.path("byte_bpe_50k.tiktoken"))
ODD = [
    None, "", "a", " ", "  ", "a  b", "a\n\nb \n c", " 's it's I'll we've they're 'd ''s \"'m x'rex 'tis", "a'", "'", "' s",
    "12 345  6a7", "x 　y  z\x1c\x1d q\x85w", "é ñ\U0001F600 \U0001F600‍½²Ⅷ 中文字",
    "<|endoftext|>", "x're'", "a" * 5000, "!" * 900, "aab" * 333, "xyzzy" * 100 + "q", "中文" * 200,
]


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RANKS.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def fuzz(seed):
    r = random.Random(seed)
    small = " '\n\tsdmtrelvLA1é　 \x1c.中½"
    return (["".join(r.choice(small) for _ in range(r.randrange(40))) for _ in range(800)]
            + ["".join(r.choice(al) for _ in range(r.randrange(64, 300)))
               for al in ("ab", "abc", "theing", "01", "=-_", "abcdefghijklmnopqrstuvwxyz") for _ in range(25)])


def test_pieces_and_ids_equal_the_library(library):
    coder = bpe.Coder.of(RANKS)
    texts = ODD + fuzz(1)
    ids, edge = coder.encode(pa.array(texts))
    for i, t in enumerate(texts):
        assert ids[edge[i]:edge[i + 1]].tolist() == library.encode_ordinary(t or ""), repr(t)[:80]
    assert coder.decode(ids, edge) == [(t or "").encode() for t in texts]


def test_a_full_cache_starts_anew(library, monkeypatch):
    coder = bpe.Coder.of(RANKS)
    coder.clear()
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    for t in fuzz(2)[:60]:
        ids, _ = coder.encode(pa.array([t]))
        assert ids.tolist() == library.encode_ordinary(t)
    assert len(coder.known) <= 50


def test_a_full_cache_keeps_the_pieces_met_again(library, monkeypatch):
    coder = bpe.Coder.of(RANKS)
    coder.clear()
    monkeypatch.setattr(bpe, "CACHE_PIECES", 60)
    asked, contract = [], coder.contract
    monkeypatch.setattr(coder, "contract", lambda raw, starts, ends: asked.append(len(starts)) or contract(raw, starts, ends))
    for k in range(20):
        text = "the same words in each text" + "".join(f" n{chr(97 + k)}{chr(97 + j)}zq" for j in range(10))
        ids, _ = coder.encode(pa.array([text]))
        assert ids.tolist() == library.encode_ordinary(text)
        assert len(coder.known) <= 60
    assert asked == [16] + [10] * 19
    coder.clear()


def test_encode_decode_frames(spark, library):
    rows = [(i, t, "clash") for i, t in enumerate(ODD)] + [(2, "a", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = bpe.decode(bpe.encode(df, RANKS), RANKS).collect()
    assert len(out) == len(rows)
    for r in out:
        assert r.ids == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    for r in bpe.digest(df, RANKS).collect():
        want = np.array(library.encode_ordinary(ODD[r.doc_id] or ""), "<u4")
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(want.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((ODD[r.doc_id] or "").encode()).hexdigest()
    assert bpe.digest(df.limit(0), RANKS).count() == 0
    nulls = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert bytes(bpe.decode(nulls, RANKS).first().decoded) == b""


def test_tasks_of_other_operators_drop_the_tokenizer():
    from ledgerlake.llm import common

    ranks = RANKS
    coder = bpe.Coder.of(ranks)
    assert bpe.Coder.of(ranks) is coder
    common.drop_caches()
    assert not bpe.Coder._kept and bpe.Coder.of(ranks) is not coder
