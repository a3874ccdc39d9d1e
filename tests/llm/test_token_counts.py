"""Prefix token counts against the library, on every prefix."""

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from ledgerlake.llm import token_counts as C

MODEL = C.model_bytes(public_tokenizers.path("piece_bpe_32k.model"))
LIBRARY = sentencepiece.SentencePieceProcessor(model_proto=MODEL)
SF = "/root/testdata/sf0.001"


def counted(text):
    return [len(x) for x in LIBRARY.encode([text[:p] for p in range(len(text) + 1)])]


@pytest.fixture(scope="module")
def counter():
    return C.PrefixCounter(MODEL)


def random_text(r, pieces):
    kind = r.random()
    if kind < 0.35:
        return "".join(r.choice(pieces) for _ in range(r.randrange(1, 12))).replace(C.MARK, " ")
    if kind < 0.6:
        return "".join(r.choice("ab  \n\té▁日本<s>🙂\0 ") for _ in range(r.randrange(1, 60)))
    if kind < 0.7:
        return r.choice(["a", " ", "ha", "==", "0", "日", "\n"]) * r.randrange(1, 70)
    return "".join(r.choice("etaoin srhl dcumf.,'\n-=") for _ in range(r.randrange(1, 80)))


def test_every_prefix_has_the_librarys_count(counter):
    r = random.Random(11)
    pieces = list(counter.score)
    fixed = ["", " ", "</s>[INST] <s> ok", "Hello  world", "a" * 300, " " * 200 + "x", "ab\ncd" * 50, "é", " "]
    for text in fixed + [random_text(r, pieces) for _ in range(400)]:
        assert list(counter.prefixes(text)) == counted(text), text


def test_a_full_memory_changes_nothing(counter, monkeypatch):
    text = " ".join(f"word{i} tail{i % 7}" for i in range(200))
    want = list(counter.prefixes(text))
    monkeypatch.setattr(C, "CACHE_CHARS", 20)
    monkeypatch.setattr(C, "CACHE_PAIRS", 3)
    assert list(C.PrefixCounter(MODEL).prefixes(text)) == want == counted(text)


def test_budgets_are_answered_from_the_counts(spark):
    r = random.Random(5)
    texts = [None, "", "unbelievable", "a b c", "internationalization of  things\n" * 3] + [random_text(r, ["xyz", "▁the", "tion"]) for _ in range(20)]
    df = spark.createDataFrame([(i, t, "keep", i) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string, prefix_tokens int")
    out = C.prefix_counts(df, MODEL)
    assert out.columns == ["doc_id", "text", "n_tokens", "prefix_tokens"]
    for budget in (0, 1, 3, 10, 1000):
        rows = C.truncated(out, budget).withColumn("n", C.tokens()).collect()
        for row in rows:
            whole = texts[row.doc_id] or ""
            best = max(p for p, c in enumerate(counted(whole)) if c <= budget)
            assert (row.text or "") == whole[:best] and row.n == counted(whole)[best] == len(row.prefix_tokens and LIBRARY.encode(whole[:best]))
    at = out.select("doc_id", C.tokens_of_prefix(2).alias("two"), C.tokens_of_prefix(F.lit(10 ** 6)).alias("all")).collect()
    for row in at:
        c = counted(texts[row.doc_id] or "")
        assert (row.two, row["all"]) == (c[min(2, len(c) - 1)], c[-1])
    with pytest.raises(ValueError):
        C.truncated(out, -1)


def test_digest_of_whole_documents_and_defined_results(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in C.digest(docs, MODEL, limit=500).collect()}
    for row in docs.collect():
        n = len(LIBRARY.encode(row.text))
        assert (got[row.doc_id].n_tokens, got[row.doc_id].n_bytes) == (n, len(row.text.encode())) and got[row.doc_id].over_limit == (n > 500)
    odd = spark.createDataFrame([(None, "a", 1), (None, "a", 1), (3, None, 2), (3, "", 3), (4, "x" * 70_000, 4)], "doc_id long, text string, n_bytes int")
    rows = sorted(C.digest(odd, MODEL).collect(), key=str)
    assert len(rows) == 5 and sum(r.n_tokens == 0 and r.n_bytes == 0 for r in rows) == 2
    assert [r.n_tokens for r in rows if r.doc_id == 4] == [len(LIBRARY.encode("x" * 70_000))]
    assert C.digest(odd.limit(0), MODEL).count() == 0
