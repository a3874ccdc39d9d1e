"""Language-model scores by stupid backoff over the corpus's own counts.

A document's score is the sum, over its words, of log10 of

    c(v w) / c(v)          if the pair was seen elsewhere,
    BACKOFF * c(w) / n     if only the word was,
    BACKOFF * BACKOFF / n  otherwise (and without the first factor at the start),

where every count leaves out the document itself, v is the word before w, and n
counts all words elsewhere.  Counts cover all documents.

The work is relational over blocks of rows.  Texts are packed into slices (word
hashes, token positions).  Each slice asks for each of its distinct words and
pairs once: blocks of sorted hashes, dealt by hash range to the partition that
holds their counts.  A partition is the join of the count table with what was
asked; its answers go back to the slices, which sum per document.  A common pair
is asked once a slice, not once an occurrence, so no partition grows with it.

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased, as 64-bit hashes.  Defined
results: null and empty texts have no words and score 0; repeated rows are
documents of their own, so each sees the other; if nothing is elsewhere (n is
0), n counts as 1; an empty table gives an empty table; only the id and text
columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import Words, drop_stored, mix, slices, stored

BACKOFF = 0.4
#: bytes of text in a slice, and keys in a partition of a count table
SLICE_BYTES, PART_KEYS = 6 << 20, 2 << 20
WORD, PAIR = 1, 2

_SLICE = "slice long, ids binary, known binary, first binary, words binary, tokens binary, n_tokens long"


def planes(x: np.ndarray) -> bytes:
    """An integer array byte plane by byte plane: small numbers compress well."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.itemsize).T.tobytes()


def unplanes(raw: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _gaps(keys: np.ndarray) -> np.ndarray:
    return np.diff(keys, prepend=np.uint64(0))


def packed(docs: DataFrame) -> DataFrame:
    """One row a slice of (id, text): its documents, distinct words and tokens."""

    def run(batches):
        part, k = TaskContext.get().partitionId(), 0
        for b in slices(batches, "text", SLICE_BYTES):
            w = Words(b.column(1))
            words, tokens = np.unique(w.hash, return_inverse=True)
            ids = b.column(0)
            yield pa.RecordBatch.from_pydict({
                "slice": pa.array([(part << 24) + k], pa.int64()),
                "ids": [ids.fill_null(0).to_numpy(zero_copy_only=False).tobytes()],
                "known": [ids.is_valid().to_numpy(zero_copy_only=False).tobytes()],
                "first": [w.first.astype(np.int64).tobytes()], "words": [planes(_gaps(words))],
                "tokens": [planes(tokens.astype(np.int32))], "n_tokens": pa.array([len(tokens)], pa.int64())})
            k += 1

    return docs.mapInArrow(run, _SLICE)


def _unpack(words: bytes, tokens: bytes, first: bytes):
    """(word hashes, tokens, first token of each document, pair hashes, token of
    each pair's second word): pairs stay within a document."""
    words = np.cumsum(unplanes(words, np.uint64), dtype=np.uint64)
    tokens, first = unplanes(tokens, np.int32), np.frombuffer(first, np.int64)
    second = np.ones(len(tokens), bool)
    starts = first[:-1]
    second[starts[starts < len(tokens)]] = False
    second = np.flatnonzero(second)
    pairs = mix(words[tokens[second - 1]] * np.uint64(0x9E3779B97F4A7C15) + mix(words[tokens[second]], 8), 9)
    return words, tokens, first, pairs, second


def _range_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """Hash ranges: ascending with the keys."""
    return ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def asked(packs: DataFrame, parts: int) -> DataFrame:
    """(level, part, slice, keys, counts): a slice's distinct keys and their
    counts in it, a row for each hash range."""

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                row = [b.column(k)[i].as_py() for k in range(4)]
                words, tokens, _, pairs, _ = _unpack(*row[1:])
                both = ((WORD, words, np.bincount(tokens, minlength=len(words))),
                        (PAIR, *np.unique(pairs, return_counts=True)))
                for level, keys, counts in both:
                    where = _range_of(keys, parts)
                    for p in np.unique(where):
                        at = slice(*np.searchsorted(where, [p, p + 1]))
                        yield pa.RecordBatch.from_pydict({
                            "level": pa.array([level], pa.int32()), "part": pa.array([p], pa.int64()),
                            "slice": pa.array([row[0]], pa.int64()), "keys": [planes(_gaps(keys[at]))],
                            "counts": [planes(counts[at].astype(np.uint32))]})

    return packs.select("slice", "words", "tokens", "first").mapInArrow(
        run, "level int, part long, slice long, keys binary, counts binary")


def answers(requests: DataFrame) -> DataFrame:
    """(slice, level, part, totals): the keys' counts over the whole corpus, in
    the order in which the slice asked."""

    def run(table: pa.Table) -> pa.Table:
        keys = [np.cumsum(unplanes(x, np.uint64), dtype=np.uint64) for x in table["keys"].to_pylist()]
        counts = np.concatenate([unplanes(x, np.uint32) for x in table["counts"].to_pylist()])
        unique, which = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(which, counts, len(unique)).astype(np.uint64)[which]
        ends = np.cumsum([len(k) for k in keys])
        out = [planes(x) for x in np.split(total, ends[:-1])]
        return pa.table({"slice": table["slice"], "level": table["level"], "part": table["part"],
                         "totals": pa.array(out, pa.binary())})

    return requests.groupBy("level", "part").applyInArrow(run, "slice long, level int, part long, totals binary")


def _own(keys: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """For each entry, how often its key occurs in its document (keys below n)."""
    _, which, counts = np.unique(doc * np.int64(max(n, 1)) + keys, return_inverse=True, return_counts=True)
    return counts[which]


def slice_scores(words, tokens, first, pairs, second, word_total, pair_total, n: int) -> np.ndarray:
    """Scores of a slice's documents from the corpus counts of its sorted
    distinct words and pairs."""
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    elsewhere = np.maximum(n - np.diff(first), 1)[doc].astype(np.float64)
    c = word_total.astype(np.int64)[tokens] - _own(tokens.astype(np.int64), doc, len(words))
    s = np.where(c > 0, c, BACKOFF) / elsewhere
    if len(second):
        _, at = np.unique(pairs, return_inverse=True)
        cc = pair_total.astype(np.int64)[at] - _own(at.astype(np.int64), doc[second], len(pair_total))
        before = np.maximum(c[second - 1], 1)
        s[second] = np.where(cc > 0, cc / before, BACKOFF * s[second])
    return np.bincount(doc, np.log10(s), len(first) - 1)


def score(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_words, score), one row per row of ``df``."""
    docs = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    packs = stored(packed(docs), "slices")
    n = packs.agg(F.sum("n_tokens")).first()[0] or 0
    back = answers(asked(packs, max(1, -(-n // PART_KEYS))))

    def run(key, mine: pa.Table, got: pa.Table) -> pa.Table:
        row = {k: mine[k][0].as_py() for k in ("ids", "known", "first", "words", "tokens")}
        words, tokens, first, pairs, second = _unpack(row["words"], row["tokens"], row["first"])
        got = got.sort_by("part")
        totals = {}
        for level in (WORD, PAIR):
            some = got.filter(pa.compute.equal(got["level"], level))["totals"].to_pylist()
            totals[level] = np.concatenate([unplanes(x, np.uint64) for x in some] or [np.empty(0, np.uint64)])
        s = slice_scores(words, tokens, first, pairs, second, totals[WORD], totals[PAIR], n)
        missing = ~np.frombuffer(row["known"], bool)
        return pa.table({"doc_id": pa.array(np.frombuffer(row["ids"], np.int64), mask=missing),
                         "n_words": pa.array(np.diff(first), pa.int64()), "score": pa.array(s, pa.float64())})

    out = packs.groupBy("slice").cogroup(back.groupBy("slice")).applyInArrow(
        run, "doc_id long, n_words long, score double").checkpoint()
    drop_stored(packs)
    return out
