"""Byte-level BPE encoding and decoding with a given rank file.

Texts are cut into the tokenizer's pieces (vectorised, over code points).  Each
piece that a task has not met yet becomes token-position rows, at first one per
byte, in an in-process DuckDB; a recursive query joins neighbouring rows with
the merge table and contracts each piece's leftmost minimum-rank pair until no
pair merges.  Texts are then written from their pieces' ids.  Decoding joins
(position, id) rows with the vocabulary and concatenates them in order.

Python workers keep the pieces they have encoded, so a frequent piece is usually
contracted once per worker.  Beyond ``CACHE_PIECES`` those go that came in one
slice of texts only: a corpus' numbers, names and junk never end, its words do.

Defined results: a null text counts as empty and has no ids; repeated rows are
encoded each by themselves; texts are encoded whole, whatever their length;
text that looks like a special token is ordinary text; an empty table gives an
empty table; further columns pass through ``encode`` untouched, and one named
like an output is replaced.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import give_back, slices, span_hashes, string_bytes, worker_cache

#: distinct pieces a Python worker remembers (about 40 bytes each, and as much again
#: while pieces are added: 20 MB a worker, however large its share of the corpus)
CACHE_PIECES = 250_000
#: pieces, and bytes of pieces, in one recursive query
QUERY_PIECES, QUERY_BYTES = 10_000, 1 << 18
#: bytes of text that are encoded and decoded again at once
SLICE_BYTES = 1 << 18
#: bytes from which a piece counts as long
LONG_BYTES = 64

# The code points of Unicode's White_Space property, and the
# contractions that the pattern splits off.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F,
               0x3000)
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

OTHER, LETTER, NUMBER, SPACE = range(4)

CONTRACT = """
WITH RECURSIVE step(w, p, t, done) AS (
  SELECT w, p, t, false FROM bytes_in
  UNION ALL
  (WITH pairs AS (
     SELECT w, p, t, lead(t) OVER follow AS nt, lag(p) OVER follow AS pp
     FROM step WHERE NOT done WINDOW follow AS (PARTITION BY w ORDER BY p)),
   best AS (
     SELECT w, min(m::BIGINT * 4294967296 + p) AS b FROM pairs JOIN merges ON l = t AND r = nt GROUP BY w)
   SELECT w, p, CASE WHEN p = b & 4294967295 THEN (b >> 32)::INTEGER ELSE t END, b IS NULL
   FROM pairs LEFT JOIN best USING (w) WHERE b IS NULL OR pp IS DISTINCT FROM b & 4294967295)
)
SELECT w, t FROM step WHERE done ORDER BY w, p
"""

# For long pieces.  Where every pair that can follow from a merged token ranks
# behind it ("calm"), contracting the leftmost minimum again and again reaches
# all its occurrences before anything else; so they contract together, every
# other one where they overlap.
CONTRACT_LONG = """
WITH RECURSIVE step(w, p, t, done) AS (
  SELECT w, p, t, false FROM bytes_in
  UNION ALL
  (WITH pairs AS (
     SELECT w, p, t, lead(t) OVER follow AS nt, lag(p) OVER follow AS pp, row_number() OVER follow AS k
     FROM step WHERE NOT done WINDOW follow AS (PARTITION BY w ORDER BY p)),
   open AS (SELECT w, p, k, m, calm FROM pairs JOIN merges ON l = t AND r = nt),
   best AS (SELECT w, min(m) AS m, min(m::BIGINT * 4294967296 + p) & 4294967295 AS leftmost FROM open GROUP BY w),
   same AS (
     SELECT w, p, k, m, calm, leftmost, k - row_number() OVER (PARTITION BY w ORDER BY p) AS chain
     FROM open JOIN best USING (w, m)),
   chosen AS (
     SELECT w, p, m FROM same
     QUALIFY p = leftmost OR calm AND row_number() OVER (PARTITION BY w, chain ORDER BY p) % 2 = 1)
   SELECT pairs.w, pairs.p, coalesce(here.m, t), best.m IS NULL
   FROM pairs LEFT JOIN best ON best.w = pairs.w
     LEFT JOIN chosen here ON here.w = pairs.w AND here.p = pairs.p
     LEFT JOIN chosen prior ON prior.w = pairs.w AND prior.p = pairs.pp
   WHERE prior.m IS NULL)
)
SELECT w, t FROM step WHERE done ORDER BY w, p
"""

DECODE = """
SELECT d, unhex(string_agg(h, '')) AS x
FROM (SELECT d, p, h FROM ids_in JOIN vocab USING (t) ORDER BY p) GROUP BY d
"""


def _classes() -> np.ndarray:
    """Letter, number, white space or other, for each code point."""
    import regex
    table = np.zeros(0x110000, np.uint8)
    points = np.arange(0x110000, dtype=np.uint32)
    points[0xD800:0xE000] = 0xFFFF                 # surrogates are no characters
    text = points.astype("<u4").tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, text):
            table[m.start():m.end()] = kind
    table[list(WHITE_SPACE)] = SPACE
    return table


def piece_starts(points: np.ndarray, first: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Which code points start a piece.  ``first``: where each text begins
    (``first[-1]`` is the end)."""
    n = len(points)
    begins = np.zeros(n + 1, bool)                  # of a text
    begins[first] = True
    begins[n] = True
    kind = classes[points]
    run = begins[:n].copy()
    run[1:] |= kind[1:] != kind[:-1]
    start = run.copy()
    runs = np.flatnonzero(run)
    ends = np.append(runs[1:], n)
    space = kind[runs] == SPACE
    # white space before more of the text leaves its last character to itself ...
    last = ends[space] - 1
    more = ~begins[last + 1]
    start[last[more]] = True
    # ... and a blank there joins the piece that follows
    follows = runs[~space]
    follows = follows[~begins[follows]]
    start[follows[points[follows - 1] == 0x20]] = False
    # contractions: a lone apostrophe that starts a piece, before the right letters
    lone = runs[(ends - runs == 1) & (points[runs] == 0x27)]
    lone = lone[start[lone]]
    for tail in CONTRACTIONS:
        at = lone[lone + len(tail) < n]
        for k, ch in enumerate(tail, 1):
            at = at[(points[at + k] == ord(ch)) & ~begins[at + k]]
        start[at + 1] = False
        after = at + 1 + len(tail)
        start[after[after < n]] = True
    return start


class Coder:
    """Encodes pieces and decodes ids of one rank file, within a Python worker."""

    _kept: dict[str, Coder] = worker_cache()

    @classmethod
    def of(cls, ranks: bytes) -> Coder:
        key = hashlib.sha256(ranks).hexdigest()
        if key not in cls._kept:
            cls._kept.clear()
            cls._kept[key] = cls(ranks)
        return cls._kept[key]

    def __init__(self, ranks: bytes):
        import duckdb
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        rank = {base64.b64decode(a): int(b) for a, b in pairs}
        left, right, merged = [], [], []
        for token, r in rank.items():
            for k in range(1, len(token)):
                if (a := rank.get(token[:k])) is not None and (b := rank.get(token[k:])) is not None:
                    left.append(a), right.append(b), merged.append(r)
        self.byte_id = np.array([rank[bytes([i])] for i in range(256)], np.int32)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        for limit in ("allocator_flush_threshold", "allocator_bulk_deallocation_flush_threshold"):
            self.con.execute(f"SET {limit} = '1MB'")      # freed memory goes back to the system
        first = np.full(max(rank.values()) + 1, np.iinfo(np.int32).max)   # rank of the first pair with a token
        for side in (left, right):
            np.minimum.at(first, side, merged)
        calm = [bool(first[m] > m) for m in merged]
        for name, cols in (("merges", {"l": left, "r": right, "m": merged, "calm": calm}),
                           ("vocab", {"t": list(rank.values()), "h": [t.hex() for t in rank]})):
            kinds = {"h": pa.string(), "calm": pa.bool_()}
            self.con.register("given", pa.table({k: pa.array(v, kinds.get(k, pa.int32())) for k, v in cols.items()}))
            self.con.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
        self.con.unregister("given")
        self.classes = _classes()
        # adjacent bytes that occur in no token never merge: a piece may be cut there
        self.glued = np.zeros((256, 256), bool)
        for token in rank:
            b = np.frombuffer(token, np.uint8)
            self.glued[b[:-1], b[1:]] = True
        self.clear()

    def clear(self) -> None:
        self.known = np.empty(0, np.uint64)           # piece hashes, sorted
        self.at, self.size = np.empty(0, np.int64), np.empty(0, np.int32)
        self.flat = np.empty(0, np.int32)             # their ids, one after another
        self.again = np.empty(0, bool)                # met in a later slice, too

    def make_room(self) -> None:
        """Forget pieces that were met in one slice only, or all if most were met again."""
        if 2 * self.again.sum() > CACHE_PIECES:
            return self.clear()
        at, self.size = self.at[self.again], self.size[self.again]
        self.known = self.known[self.again]
        edge = np.cumsum(self.size, dtype=np.int64)
        self.at = edge - self.size
        self.flat = self.flat[np.repeat(at - self.at, self.size) + np.arange(edge[-1] if len(edge) else 0)]
        self.again = np.zeros(len(self.known), bool)

    def contract(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per piece) of the byte spans, by the recursive query."""
        sizes = ends - starts
        total = int(sizes.sum())
        word = np.repeat(np.arange(len(starts)), sizes)
        pos = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        data = raw[np.repeat(starts, sizes) + pos]
        cut = np.ones(total, bool)                    # where a part that merges within itself begins
        cut[1:] = (pos[1:] == 0) | ~self.glued[data[:-1], data[1:]]
        part = np.cumsum(cut) - 1
        long = np.bincount(part)[part] >= LONG_BYTES
        parts, ids = [], []
        for query, rows in ((CONTRACT, ~long), (CONTRACT_LONG, long)):
            if rows.any():
                self.con.register("bytes_in", pa.table({"w": part[rows].astype(np.int32), "p": pos[rows],
                                                        "t": self.byte_id[data[rows]]}))
                got = self.con.execute(query).fetchnumpy()
                self.con.unregister("bytes_in")
                parts.append(np.asarray(got["w"])), ids.append(np.asarray(got["t"]))
        parts, ids = np.concatenate(parts), np.concatenate(ids).astype(np.int32)
        order = np.argsort(parts, kind="stable")
        return ids[order], np.bincount(word[cut][parts], minlength=len(starts))

    def learn(self, raw: np.ndarray, hashes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        """Encode pieces that are not known yet (hashes sorted and unique)."""
        ids, counts, i = [], [], 0
        edge = np.cumsum(ends - starts)
        while i < len(starts):
            base = edge[i - 1] if i else 0
            j = min(i + QUERY_PIECES, max(i + 1, int(np.searchsorted(edge, base + QUERY_BYTES, "right"))))
            a, b = self.contract(raw, starts[i:j], ends[i:j])
            ids.append(a), counts.append(b)
            i = j
        counts = np.concatenate(counts).astype(np.int32)
        at = len(self.flat) + np.cumsum(counts, dtype=np.int64) - counts
        self.flat = np.concatenate([self.flat, *ids])
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.at, self.size = np.insert(self.at, where, at), np.insert(self.size, where, counts)
        self.again = np.insert(self.again, where, False)

    def unknown(self, hashes: np.ndarray) -> np.ndarray:
        """Which of the hashes (unique) are not known; the others are marked as met again."""
        if not len(self.known):
            return np.ones(len(hashes), bool)
        found = np.minimum(np.searchsorted(self.known, hashes), len(self.known) - 1)
        new = self.known[found] != hashes
        self.again[found[~new]] = True
        return new

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids one after another, offsets of the texts in them)."""
        raw, offsets = string_bytes(texts)
        offsets = offsets - offsets[0]
        if not len(raw):
            return np.empty(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        points = np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), "<u4")
        byte_at = np.flatnonzero((raw & 0xC0) != 0x80)
        starts = byte_at[piece_starts(points, np.searchsorted(byte_at, offsets), self.classes)]
        ends = np.append(starts[1:], len(raw))
        hashes = span_hashes(raw, starts, ends)
        unique, one, which = np.unique(hashes, return_index=True, return_inverse=True)
        new = self.unknown(unique)
        for room in (self.make_room, self.clear):
            if len(self.known) and len(self.known) + new.sum() > CACHE_PIECES:
                room()
                new = self.unknown(unique)
        if new.any():
            self.learn(raw, unique[new], starts[one[new]], ends[one[new]])
        found = np.searchsorted(self.known, unique)[which]
        size = self.size[found].astype(np.int64)
        edge = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.at[found] - edge[:-1], size) + np.arange(edge[-1])]
        return ids, edge[np.searchsorted(starts, offsets)]

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The bytes of each id sequence, by an ordered aggregation."""
        d = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        self.con.register("ids_in", pa.table({"d": d, "p": np.arange(len(ids), dtype=np.int64),
                                              "t": ids.astype(np.int32)}))
        out = [b""] * (len(offsets) - 1)
        for k, x in self.con.execute(DECODE).fetchall():
            out[k] = x
        self.con.unregister("ids_in")
        return out


def ranks_bytes(path: str) -> bytes:
    """A rank file's content: bounded (under 2 MB), sent along with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def encode(df: DataFrame, ranks: bytes, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (array of int)."""
    kept = [c for c in df.columns if c != "ids"]
    df = df.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder.of(ranks)
        for b in slices(batches, text):
            ids, offsets = coder.encode(b.column(b.schema.get_field_index(text)))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*kept, "ids"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType()))]))


def decode(df: DataFrame, ranks: bytes, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded`` (binary); null ids decode to nothing."""
    kept = [c for c in df.columns if c != "decoded"]
    df = df.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches):
        coder = Coder.of(ranks)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                b = batch.slice(at, 256)
                lists = b.column(b.schema.get_field_index(ids)).fill_null([])
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                sizes = np.asarray(lists.value_lengths())
                out = coder.decode(flat, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*kept, "decoded"])

    return df.mapInArrow(run, T.StructType([*df.schema.fields, T.StructField("decoded", T.BinaryType())]))


def digest(df: DataFrame, ranks: bytes) -> DataFrame:
    """One row per document of (doc_id, text): encode, decode the ids, digest
    both where they are (the ids of a corpus are larger than its texts)."""

    def run(batches):
        coder = Coder.of(ranks)
        for b in slices(batches, "text"):
            ids, edge = coder.encode(b.column(1))
            back = coder.decode(ids, edge)
            raw = ids.astype("<u4").tobytes()
            yield pa.RecordBatch.from_arrays([
                b.column(0), pa.array(np.diff(edge), pa.int64()),
                pa.array([hashlib.sha256(raw[4 * a:4 * z]).hexdigest() for a, z in zip(edge[:-1], edge[1:])], pa.string()),
                pa.array([hashlib.sha256(x).hexdigest() for x in back], pa.string()),
            ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def checked(df: DataFrame, ranks: bytes) -> DataFrame:
    """``df`` with ``ids``, ``n_tokens`` and ``round_trip``: whether the decoded
    ids are the text's bytes (slice by slice, so that decoded texts never gather)."""
    added = ("ids", "n_tokens", "round_trip")
    kept = [c for c in df.columns if c not in added]
    df = df.select(*[F.col(f"`{c}`") for c in kept])

    def run(batches):
        coder = Coder.of(ranks)
        for b in slices(batches, "text", SLICE_BYTES):
            col = b.column(b.schema.get_field_index("text"))
            ids, edge = coder.encode(col)
            raw, offsets = string_bytes(col)
            raw, offsets = raw.tobytes(), offsets - offsets[0]
            same = [x == raw[a:z] for x, a, z in zip(coder.decode(ids, edge), offsets[:-1], offsets[1:])]
            lists = pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([*b.columns, lists, pa.array(np.diff(edge), pa.int64()),
                                              pa.array(same, pa.bool_())], names=[*kept, *added])
            give_back()

    kinds = (T.ArrayType(T.IntegerType()), T.LongType(), T.BooleanType())
    return df.mapInArrow(run, T.StructType([*df.schema.fields, *map(T.StructField, added, kinds)]))
