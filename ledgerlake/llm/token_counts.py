"""Exact token counts of every prefix of a text, for a piece model (BPE over
code points with byte fallback).

The encoding of a text's first i code points ends in exactly one piece t, and
what stands before t is the encoding of the first i - len(t) code points: t is
the piece that may follow that encoding's last piece.  So the count at i is the
count at i - len(t) plus one, and one pass over a text gives the counts of all
its prefixes.  Whether a piece may follow another is settled by merging the two
by themselves, once per pair.

No piece holds a space mark after another character, nor any of the signs that
the model does not know, so a text falls apart into words that are counted by
themselves; a Python worker remembers the words it has counted (at most
``CACHE_CHARS`` code points, then it starts anew).  Words are cut further wherever
two neighbouring characters stand side by side in no piece.

The table of counts answers questions about budgets without encoding again:
``tokens_of_prefix``, ``longest_prefix`` and ``truncated`` are plain Spark
expressions over it.  Counts may fall from one prefix to the next (a character
can complete a longer piece), so the longest prefix within a budget is the last
that fits, not the one before the first that does not.

Defined results: a null text counts as empty and has no tokens; repeated rows
are counted each by themselves; texts are counted whole (four bytes a code
point, one text at a time); strings like ``<s>`` are ordinary text, as the
library takes them; an empty table gives an empty table; further columns pass
through, and one named like an output is replaced.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import slices

#: code points of counted words that a Python worker remembers
CACHE_CHARS = 6_000_000
#: pairs of pieces that a Python worker remembers
CACHE_PAIRS = 2_000_000
#: longer words are not remembered
LONG_CHARS = 48
#: the mark that the model family puts in place of a space
MARK = "▁"


def model_bytes(path: str) -> bytes:
    """The model file, read on the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


class PrefixCounter:
    """Counts of all prefixes, by the pieces and scores of a model."""

    def __init__(self, model: bytes):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.score: dict[str, float] = {}
        for i in range(sp.GetPieceSize()):
            if not (sp.IsByte(i) or sp.IsControl(i) or sp.IsUnknown(i)):
                self.score[sp.IdToPiece(i)] = sp.GetScore(i)
        known = set("".join(self.score))
        if not known <= self.score.keys():
            raise ValueError("a piece holds a character that is no piece itself")
        self.couples = {p[i:i + 2] for p in self.score for i in range(len(p) - 1)}
        if any(c[1] == MARK and c[0] != MARK for c in self.couples):
            raise ValueError("a piece holds a space mark after another character")
        apart = "".join(c for c in "\n\t\r" if c not in known)
        self.words = re.compile(f"{MARK}+[^{MARK}{apart}]*|[^{MARK}{apart}]+|[{apart}]" if apart
                                else f"{MARK}+[^{MARK}]*|[^{MARK}]+")
        self.seen: dict[str, list[int]] = {}
        self.seen_chars = 0
        self.follows: defaultdict[str, dict[str, bool]] = defaultdict(dict)
        self.pairs = 0
        self.endings: dict = {}         # the pieces by their characters from the last to the first
        for p in self.score:
            node = self.endings
            for c in reversed(p):
                node = node.setdefault(c, {})
            node[""] = p

    def merged(self, text: str) -> list[str]:
        """The pieces of a short text: best score first, then leftmost."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def may_follow(self, before: str, piece: str) -> bool:
        """Whether the two stay apart when they stand side by side."""
        if self.pairs >= CACHE_PAIRS:
            for known in self.follows.values():
                known.clear()
            self.pairs = 0
        self.pairs += 1
        known = self.follows[before][piece] = self.merged(before + piece) == ([before, piece] if before else [piece])
        return known

    def _counted(self, word: str) -> list[int]:
        """Counts of the prefixes 1..n of a word, by dynamic programming over
        the pieces that end at each character."""
        n, follows, endings = len(word), self.follows, self.endings
        count, last = [0] * (n + 1), [""] * (n + 1)
        for i in range(1, n + 1):
            node, k = endings, i
            while k:
                k -= 1
                node = node.get(word[k])
                if node is None:
                    k = 0
                    continue
                if "" in node:
                    piece = node[""]
                    fits = follows[last[k]].get(piece)
                    if fits is None:
                        fits = self.may_follow(last[k], piece)
                    if fits:
                        count[i], last[i] = count[k] + 1, piece
                        break
            if not count[i]:            # no piece ends here: the character's bytes
                count[i] = count[i - 1] + len(word[i - 1].encode())
        return count[1:]

    def word(self, word: str) -> list[int]:
        """Counts of a word, put together from what no piece reaches over."""
        counts = self.seen.get(word)
        if counts is None:
            couples = self.couples
            cuts = [i + 1 for i in range(len(word) - 1) if word[i:i + 2] not in couples]
            if cuts:
                counts, a = [], 0
                for b in (*cuts, len(word)):
                    before = counts[-1] if counts else 0
                    counts += [before + c for c in self.word(word[a:b])]
                    a = b
            else:
                counts = self._counted(word)
            if len(word) <= LONG_CHARS:
                self.seen_chars += len(word)
                if self.seen_chars > CACHE_CHARS:
                    self.seen.clear()
                    self.seen_chars = len(word)
                self.seen[word] = counts
        return counts

    def prefixes(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 0, 1, .., len(text) code points."""
        if not text:
            return np.zeros(1, np.int32)
        seen, word = self.seen.get, self.word
        words = [seen(w) or word(w) for w in self.words.findall(MARK + text.replace(" ", MARK))]
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.fromiter(chain.from_iterable(words), np.int64, int(sizes.sum()))
        totals = counts[np.cumsum(sizes) - 1]
        counts += np.repeat(np.cumsum(totals) - totals, sizes)
        counts[0] = 0                   # the mark in front of every text is no prefix of it
        return counts.astype(np.int32)


_counters: dict[int, PrefixCounter] = {}


def _counter(model: bytes) -> PrefixCounter:
    """One counter per worker and model, so that its words stay known."""
    key = hash(model)
    if key not in _counters:
        _counters[key] = PrefixCounter(model)
    return _counters[key]


def prefix_counts(docs: DataFrame, model: bytes, text: str = "text") -> DataFrame:
    """``docs`` with ``prefix_tokens``: at index p (from 0) the number of tokens
    of the first p code points of the text."""
    kept = docs.drop("prefix_tokens")
    schema = T.StructType([*kept.schema.fields, T.StructField("prefix_tokens", T.ArrayType(T.IntegerType(), False))])
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(sent.value)
        for b in slices(batches, text):
            counts = [counter.prefixes(t.as_py() or "") for t in b.column(b.schema.get_field_index(text))]
            ends = np.concatenate([[0], np.cumsum([len(c) for c in counts])]).astype(np.int32)
            column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(counts), pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, column], names=[*b.schema.names, "prefix_tokens"])

    return kept.mapInArrow(run, schema)


# ---- questions to the stored counts -------------------------------------------

def tokens(counts: str = "prefix_tokens") -> Column:
    """Tokens of the whole text."""
    return F.element_at(counts, -1).cast("long")


def tokens_of_prefix(chars: Column | int, counts: str = "prefix_tokens") -> Column:
    """Tokens of the first ``chars`` code points (of the whole text, if it has fewer)."""
    at = F.greatest(F.least(F.lit(chars) if isinstance(chars, int) else chars, F.size(counts) - 1), F.lit(0))
    return F.element_at(counts, at.cast("int") + 1).cast("long")


def longest_prefix(budget: int, counts: str = "prefix_tokens") -> Column:
    """Code points of the longest prefix of at most ``budget`` tokens."""
    fits = F.transform(counts, lambda c: c <= F.lit(int(budget)))
    return F.size(counts) - F.array_position(F.reverse(fits), F.lit(True))


def truncated(counted: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """``counted`` with its texts cut to their longest prefix within the budget,
    and the counts to those of what is left."""
    if budget < 0:
        raise ValueError("a budget is not negative")
    keep = longest_prefix(budget).cast("int")
    return counted.withColumns({text: F.substring(F.col(text), F.lit(1), keep),
                                "prefix_tokens": F.slice("prefix_tokens", F.lit(1), keep + 1)})


def digest(docs: DataFrame, model: bytes, limit: int = 4096) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every row."""
    counted = prefix_counts(docs.select("doc_id", "text"), model)
    return counted.select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"),
                          tokens().alias("n_tokens"), (tokens() > limit).alias("over_limit"))
