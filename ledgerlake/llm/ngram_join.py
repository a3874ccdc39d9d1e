"""N-gram Jaccard join with a token-group matrix.

A document's set holds its distinct shingles of ``N`` words; two documents link
when their sets' Jaccard similarity is at least ``NUM / DEN``.  The join returns
the classes (components) of linked documents, and loses no link:

1. Equal sets are one class, and go on as one representative.
2. Representatives with equal min-hash bands are compared with their band's
   leader; confirmed links partition them into groups of similar documents.
   Large groups are stored in pieces of about ``PIECE`` members.
3. The token-group matrix holds, for each piece, the union of its members'
   leading tokens (few per member: see below).  A query document's tokens are
   joined with it.  Where the overlap is zero, no member of the piece can reach
   the similarity, nor where the sizes differ too much; members of the query's
   own group are linked to it already.  Only the other pieces are opened, and
   the query is compared with their members of fitting size.
4. Links of both kinds give the components.

Leading tokens: all sets are sorted in one order, rare tokens first.  If two sets
link, the first ``n - ceil(t n) + 1`` tokens of the larger and the first ``n -
ceil(2 t / (1 + t) n) + 1`` of the smaller share one, for any such order.  So the
order may come from approximate counts: a sketch of fixed size, summed over all
documents.

Before a pair's sets are sent to be compared, two bitmaps of about a bit a token
are: bit k tells whether an odd number of the set's tokens falls on k.  Bits that
differ are no more than the tokens that only one set has, and of these two sets
that link have at most ``(DEN - NUM) / (DEN + NUM)`` of their sizes' sum.

Tokens are 64-bit hashes.  Defined results: nulls, empty texts and texts
without words have an empty set and link with nothing; with fewer than ``N``
words the whole sequence is the one shingle; a null id links with nothing and
has a null component; repeated rows are returned each, in one component; ids are
taken to name one text (rows of one id with different texts may link through
either); an empty table gives an empty table; only the id and text columns are
read.  ``one_of_each`` names rows by their content instead, nulls included.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm.common import SMALL_BLOCK, Words, components, drop_caches, drop_stored, held, mix, packed, slices, stored

N = 5
NUM, DEN = 3, 4
#: min-hash bands, and min-hashes in a band: they only decide how links are found
BANDS, ROWS = 6, 2
#: members of a piece of a group
PIECE = 256
#: counters of the frequency sketch (4 MB; fixed, whatever the corpus)
SKETCH = 1 << 20
SKETCH_PARTS = 64
#: steps of the order for each doubling of a counter: a crowded counter stands for
#: many rare tokens, and only a step finer than their spread lifts a frequent one out
SKETCH_STEPS = 1024
#: sums of a part of the sketch, before they are added to one
SKETCH_SALTS = 16
#: rows up to which a table of ids (under 32 bytes each) is sent to the texts
#: instead of shuffling both; the result is the same
BROADCAST_IDS = 1_000_000


# ---- sets -------------------------------------------------------------------

def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = Words(texts)
    h, first = w.hash, w.first
    rolled = np.zeros(len(h), np.uint64)
    for k in range(N):
        rolled[:len(h) - k] += mix(h[k:], 10 + k)
    rolled = mix(rolled, 3)
    out = []
    for a, b in zip(first[:-1], first[1:]):
        n = b - a
        if n >= N:
            out.append(np.unique(rolled[a:b - N + 1]))
        elif n:
            whole = np.array([n], np.uint64)
            for k in range(a, b):
                whole = mix(whole * np.uint64(31) + h[k:k + 1], 5)
            out.append(whole)
        else:
            out.append(np.empty(0, np.uint64))
    return out


def needed(n: int, top: int, bottom: int) -> int:
    """ceil(top / bottom * n) in integers."""
    return -(-n * top // bottom)


def sketch(docs: DataFrame) -> np.ndarray:
    """Classes (``SKETCH_STEPS`` a doubling) of approximate token counts over all
    documents (2 MB)."""
    width = SKETCH // SKETCH_PARTS
    kind = "part int, salt int, counts binary"

    def count(batches):
        total = np.zeros(SKETCH, np.int64)
        for b in slices(batches, "text", SMALL_BLOCK):
            tokens = np.concatenate(shingle_sets(b.column(0)))
            total += np.bincount((tokens % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
        salt = TaskContext.get().partitionId() % SKETCH_SALTS
        for p in range(SKETCH_PARTS):
            yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "salt": pa.array([salt], pa.int32()),
                                              "counts": [total[p * width:(p + 1) * width].tobytes()]})

    def add(batches):
        sums: dict = {}
        for b in batches:
            for p, s, raw in zip(*(b.column(k).to_pylist() for k in range(3))):
                got = np.frombuffer(raw, np.int64)
                sums[p, s] = sums[p, s] + got if (p, s) in sums else got
        for (p, s), got in sums.items():
            yield pa.RecordBatch.from_pydict({"part": pa.array([p], pa.int32()), "salt": pa.array([0], pa.int32()),
                                              "counts": [got.tobytes()]})

    def class_(batches):
        for b in add(batches):
            total = np.frombuffer(b.column(2)[0].as_py(), np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(
                [(np.log2(total + 1) * SKETCH_STEPS).astype(np.uint16).tobytes()])], names=["part", "salt", "counts"])

    parts = docs.select("text").mapInArrow(count, kind)
    parts = parts.repartition("part", "salt").mapInArrow(add, kind)      # salted first, then by part
    parts = parts.repartition("part", "salt").mapInArrow(class_, kind)
    classes = np.zeros(SKETCH, np.uint16)
    for r in parts.collect():                     # SKETCH_PARTS rows
        classes[r.part * width:(r.part + 1) * width] = np.frombuffer(r.counts, np.uint16)
    return classes


def _print(s: np.ndarray) -> bytes:
    return mix(s, 21).sum(dtype=np.uint64).tobytes() + mix(s, 22).sum(dtype=np.uint64).tobytes()


def parities(s: np.ndarray) -> np.ndarray:
    """For each k, whether an odd number of tokens falls on k: a power of two of
    bits, at least one a token and 64."""
    size = max(64, 1 << max(0, len(s) - 1).bit_length())
    odd = np.bincount((s & np.uint64(size - 1)).astype(np.int64), minlength=size).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.int64)


def _xor(x: Column, y: Column) -> Column:
    return F.zip_with(x, y, lambda a, b: a.bitwiseXOR(b))


def may_reach(n: Column, x: Column, m: Column, y: Column) -> Column:
    """False only where sets of n and m tokens with the bitmaps x and y cannot reach
    the similarity."""
    def folded(x, y):                             # sizes that fit differ less than twofold
        half = F.size(x) / 2
        return F.when(F.size(x) > F.size(y), _xor(F.slice(x, F.lit(1), half.cast("int")),
                                                  F.slice(x, (half + 1).cast("int"), half.cast("int")))).otherwise(x)

    apart = F.aggregate(F.transform(_xor(folded(x, y), folded(y, x)), F.bit_count), F.lit(0), lambda a, b: a + b)
    return _fits(F.least(n, m), F.greatest(n, m)) & ((NUM + DEN) * apart <= (DEN - NUM) * (n + m))


def signatures(docs: DataFrame) -> DataFrame:
    """(id, n, fp, bands) of each document: its set's size, a 128-bit
    fingerprint (null if the set is empty) and its band keys."""

    def run(batches):
        drop_caches()
        for b in slices(batches, "text", SMALL_BLOCK):
            n, prints, bands = [], [], []
            for s in shingle_sets(b.column(1)):
                n.append(len(s))
                if not len(s):
                    prints.append(None), bands.append(None)
                    continue
                low = np.array([mix(s, 40 + k).min() for k in range(BANDS * ROWS)], np.uint64).reshape(BANDS, ROWS)
                low = mix((low * np.arange(3, 3 + 2 * ROWS, 2, dtype=np.uint64)).sum(1, dtype=np.uint64), 60)
                prints.append(_print(s)), bands.append(low.view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(prints, pa.binary()),
                                              pa.array(bands, pa.list_(pa.int64()))], names=["id", "n", "fp", "bands"])

    return docs.select("id", "text").mapInArrow(run, "id long, n long, fp binary, bands array<long>")


def prefixes(docs: DataFrame, classes) -> DataFrame:
    """(id, fp, n, grp, piece, prefix, bits) of (id, text, grp, piece): each set's
    leading tokens in the common order (frequency class, then token) and its bitmap."""

    def run(batches):
        order = classes.value
        for b in slices(batches, "text", SMALL_BLOCK):
            sets = shingle_sets(b.column(1))
            heads = []
            for s in sets:
                key = order[(s % np.uint64(SKETCH)).astype(np.int64)]
                # stable: equal classes keep the sorted tokens' order
                heads.append(s[np.argsort(key, kind="stable")[:len(s) - needed(len(s), NUM, DEN) + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([_print(s) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                 b.column(2), b.column(3), pa.array(heads, pa.list_(pa.int64())),
                 pa.array([parities(s) for s in sets], pa.list_(pa.int64()))],
                names=["id", "fp", "n", "grp", "piece", "prefix", "bits"])

    return docs.select("id", "text", "grp", "piece").mapInArrow(
        run, "id long, fp binary, n long, grp long, piece long, prefix array<long>, bits array<long>")


def _small(df: DataFrame) -> DataFrame:
    """Marked for broadcast if its checked size allows."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def likely(pairs: DataFrame, heads: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) that the bitmaps do not rule out."""
    sets = heads.select("id", "n", "bits")
    ours = sets.select(F.col("id").alias("a"), F.col("n").alias("x"), F.col("bits").alias("x_bits"))
    theirs = sets.select(F.col("id").alias("b"), F.col("n").alias("y"), F.col("bits").alias("y_bits"))
    return (theirs.join(_small(pairs), "b").join(ours, "a").where(may_reach(F.col("x"), F.col("x_bits"), F.col("y"), F.col("y_bits")))
            .select("a", "b").distinct().transform(held))


#: pairs that one task verifies at once, partners of one row, and tasks of one row
GROUP_PAIRS, ROW_PARTNERS, ROW_GROUPS = 512, 256, 1024


def verify(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The distinct pairs (a, b) whose sets reach the similarity.

    Pairs are dealt to groups by a.  A set travels once to each group that needs it,
    however many of the group's pairs it is in, so the leader of thousands of copies
    is sent some dozen times; a document with many partners is dealt to many groups.
    An id with several texts has several sets, any of which may link it."""
    total = pairs.count()
    groups = max(1, -(-total // GROUP_PAIRS))
    shares = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / ROW_PARTNERS).alias("shares"))
    asked = (pairs.join(shares, "a").groupBy("a", F.pmod(F.xxhash64("b"), F.col("shares")).alias("share"))
             .agg(F.collect_list("b").alias("partners"))
             .withColumn("grp", F.pmod(F.xxhash64("a", "share"), F.lit(groups)))).transform(held)
    wanted = (asked.select("grp", F.explode("partners").alias("b")).distinct()
              .groupBy("b", F.floor(F.col("grp") / ROW_GROUPS).alias("share")).agg(F.collect_list("grp").alias("grps")))
    small = total <= BROADCAST_IDS                     # at most 16 bytes a pair in either table
    asked, wanted = (F.broadcast(asked), F.broadcast(wanted)) if small else (asked, wanted)

    def left(batches):
        for b in slices(batches, "text", SMALL_BLOCK):
            yield pa.RecordBatch.from_arrays(
                [b.column(2), b.column(0), pa.array([s.view(np.int64) for s in shingle_sets(b.column(1))], pa.list_(pa.int64())),
                 b.column(3)], names=["grp", "id", "set", "partners"])

    def right(batches):
        for b in slices(batches, "text", SMALL_BLOCK):
            sets = [s.view(np.int64) for s in shingle_sets(b.column(1))]
            for i, s, grps in zip(b.column(0).to_pylist(), sets, b.column(2).to_pylist()):
                for at in range(0, len(grps), 64):
                    some = grps[at:at + 64]
                    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array([i] * len(some), pa.int64()),
                                                      pa.array([s] * len(some), pa.list_(pa.int64()))], names=["grp", "id", "set"])

    def links(key, ours: pa.Table, theirs: pa.Table) -> pa.Table:
        sets: dict = {}
        for i, s in zip(theirs["id"].to_pylist(), theirs["set"]):
            sets.setdefault(i, []).append(s.values.to_numpy().view(np.uint64))
        found = []
        for i, s, partners in zip(ours["id"].to_pylist(), ours["set"], ours["partners"].to_pylist()):
            mine = s.values.to_numpy().view(np.uint64)
            for other in partners:
                for their in sets.get(other, ()):
                    few, many = (mine, their) if len(mine) <= len(their) else (their, mine)
                    if not len(few) or DEN * len(few) < NUM * len(many):
                        continue
                    at = np.minimum(np.searchsorted(many, few), len(many) - 1)
                    both = int((many[at] == few).sum())
                    if DEN * both >= NUM * (len(few) + len(many) - both):
                        found.append((i, other))
                        break
        a, b = zip(*found) if found else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ours = (docs.join(asked, docs["id"] == asked["a"]).select(docs["id"], docs["text"], "grp", "partners")
            .mapInArrow(left, "grp long, id long, set array<long>, partners array<long>"))
    theirs = (docs.join(wanted, docs["id"] == wanted["b"]).select(docs["id"], docs["text"], "grps")
              .mapInArrow(right, "grp long, id long, set array<long>"))
    return (ours.groupBy("grp").cogroup(theirs.groupBy("grp")).applyInArrow(links, "a long, b long").distinct().transform(held))


#: queries that meet a piece in one task
PIECE_QUERIES = 2000


def opened(open_: DataFrame, heads: DataFrame) -> DataFrame:
    """(id, b): of the opened pieces (id, g, p), the members that the bound on the
    overlap does not rule out.  Many queries of one piece are dealt over as many
    copies of it."""

    def run(key, asked: pa.Table, members: pa.Table) -> pa.Table:
        a, b = [], []
        if asked.num_rows and members.num_rows:
            ids, m = members["b"].to_numpy(), members["n"].to_numpy()
            lead = m - (m * 2 * NUM + NUM + DEN - 1) // (NUM + DEN) + 1
            sets = [np.array(x[:k], np.int64) for x, k in zip(members["prefix"].to_pylist(), lead)]
            token = np.concatenate(sets)
            who = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            after = m[who] - 1 - np.concatenate([np.arange(len(x)) for x in sets])
            order = np.argsort(token, kind="stable")
            token, who, after = token[order], who[order], after[order]
            for q, n, head in zip(asked["id"].to_pylist(), asked["n"].to_pylist(), asked["prefix"].to_pylist()):
                head = np.array(head, np.int64)
                lo, hi = np.searchsorted(token, head, "left"), np.searchsorted(token, head, "right")
                at = np.concatenate([np.arange(x, y) for x, y in zip(lo, hi)] or [np.empty(0, int)]).astype(int)
                left = np.repeat(n - 1 - np.arange(len(head)), hi - lo)
                shared = np.bincount(who[at], minlength=len(ids))
                rest = np.full(len(ids), np.iinfo(np.int64).max)
                np.minimum.at(rest, who[at], np.minimum(left, after[at]))
                good = (shared > 0) & (m <= n) & (DEN * m >= NUM * n) & (ids != q)
                good &= (NUM + DEN) * (shared + np.where(good, rest, 0)) >= NUM * (n + m)
                a += [q] * int(good.sum())
                b += ids[good].tolist()
        return pa.table({"id": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    ways = open_.groupBy("g", "p").agg(F.ceil(F.count(F.lit(1)) / PIECE_QUERIES).alias("ways")).transform(held)
    # few documents ask, as a rule: then their rows go to all, and not all to them
    asked = (_small(open_.join(ways, ["g", "p"]).withColumn("way", F.pmod(F.xxhash64("id"), F.col("ways"))))
             .join(heads.select("id", "n", "prefix"), "id").select("g", "p", "way", "id", "n", "prefix"))
    members = (heads.where("piece >= 0").select(F.col("grp").alias("g"), F.col("piece").alias("p"), F.col("id").alias("b"),
                                                "n", "prefix")
               .join(ways, ["g", "p"]).withColumn("way", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ways") - 1)))
               .select("g", "p", "way", "b", "n", "prefix"))
    return asked.groupBy("g", "p", "way").cogroup(members.groupBy("g", "p", "way")).applyInArrow(run, "id long, b long")


def _fits(small: Column, large: Column) -> Column:
    return (small <= large) & (DEN * small >= NUM * large)


def jaccard_classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``df``."""
    spark = df.sparkSession
    docs = df.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    named = docs.where("id is not null")
    sigs = stored(signatures(docs), "signatures")
    # rows that repeat an id are rare; where there are any, sets are combined by id first
    repeated = sigs.where("id is not null").groupBy("id").count().where("count > 1").limit(1).count() > 0
    # equal sets: one representative each, the smallest id; combined before the shuffle
    rows = sigs.count()
    reps = stored(packed(sigs.where("id is not null and n > 0").groupBy("n", "fp").agg(F.min(F.struct("id", "bands")).alias("s"))
                         .select("s.id", "n", "fp", "s.bands"), rows * 96), "representatives")

    # leaders of bands
    banded = reps.select("id", "n", F.explode("bands").alias("band"))
    leaders = banded.groupBy("band").agg(F.min(F.struct("id", "n")).alias("l"), F.count(F.lit(1)).alias("k")).where("k > 1").transform(held)
    pairs = (banded.join(leaders, "band").where("id <> l.id")
             .where(_fits(F.least("n", "l.n"), F.greatest("n", "l.n")))
             .select(F.col("id").alias("a"), F.col("l.id").alias("b")).distinct().transform(held))
    first = verify(named, pairs)

    # groups and their pieces
    found = components(first)
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("members")).transform(held)
    grouped = found.join(sizes, "component").select("id", F.col("component").alias("grp"), F.pmod(
        F.xxhash64("id"), F.ceil(F.col("members") / PIECE)).alias("piece")).transform(held)
    classes = spark.sparkContext.broadcast(sketch(named))
    copies = (sigs.where("id is not null and n > 0").select("id").distinct()
              .join(reps.select("id"), "id", "left_anti")).transform(held)
    heads = prefixes(named.join(_small(copies), "id", "left_anti").join(_small(grouped), "id", "left")
                     .select("id", "text", F.coalesce("grp", "id").alias("grp"),
                             F.coalesce("piece", F.lit(-1)).cast("long").alias("piece")), classes)
    if repeated:
        heads = heads.groupBy("id", "fp").agg(F.first(F.struct("n", "grp", "piece", "prefix", "bits")).alias("s")).select("id", "s.*")
    heads = stored(heads.select("id", "n", "grp", "piece", "prefix", "bits").where("n > 0"), "heads")

    # the matrix, and the queries' overlap with it: a piece without a shared leading
    # token, or without a member of fitting size, stays closed
    tokens = heads.select("id", "n", "grp", "piece", F.posexplode("prefix").alias("at", "token"))
    lead = F.expr(f"n - (n * {2 * NUM} + {NUM + DEN} - 1) div {NUM + DEN} + 1")
    index = tokens.where(F.col("at") < lead).select(
        "token", F.col("grp").alias("g"), F.col("piece").alias("p"), F.col("id").alias("b"), F.col("n").alias("m"),
        (F.col("n") - F.col("at") - 1).alias("after"))
    none = F.lit(None).cast("long")
    # a single document is its own group: its id stands for it
    single = index.where("p = -1").select("token", none.alias("g"), "p", "b", F.col("m").alias("low"),
                                          F.col("m").alias("high"), "after")
    union = (index.where("p >= 0").groupBy("token", "g", "p")
             .agg(F.min("b").alias("b"), F.min("m").alias("low"), F.max("m").alias("high"))
             .select("token", "g", "p", "b", "low", "high", none.alias("after")))
    queries = tokens.select("token", "id", "n", F.when(F.col("grp") != F.col("id"), F.col("grp")).alias("grp"),
                            (F.col("n") - F.col("at") - 1).alias("left"))
    # a row for each query and member or piece, not for each token that they share
    met = (queries.join(single.unionByName(union), "token")
           .where(F.coalesce("grp", "id") != F.coalesce("g", "b"))
           .where((F.col("low") <= F.col("n")) & (DEN * F.col("high") >= NUM * F.col("n")))
           .groupBy("id", "n", "g", "p", "b", F.col("low").alias("m"))
           .agg(F.count(F.lit(1)).alias("shared"), F.min("left").alias("left"), F.min("after").alias("after")).transform(held))

    # a group that a query may link with is first tried through the one member that
    # shares most with it: a confirmed link makes them one group, and spares the rest
    near = met.where("g is not null")
    tried = (near.groupBy("id", "g", "b").agg(F.sum("shared").alias("k"))
             .groupBy("id", "g").agg(F.max(F.struct("k", "b")).alias("s"))
             .select(F.col("id").alias("a"), "s.b").where("a <> b").distinct().transform(held))
    links = first.union(verify(named, likely(tried, heads)))
    united = components(links)
    own, other = united.select("id", F.col("component").alias("c")), \
        united.select(F.col("id").alias("g"), F.col("component").alias("d"))
    open_ = (near.select("id", "g", "p").distinct().join(own, "id", "left").join(other, "g", "left")
             .where(F.coalesce("c", "id") != F.coalesce("d", "g")).select("id", "g", "p").transform(held))

    # of two documents, the tokens shared among the leading ones, and those that
    # follow the last of them in either set, bound the overlap
    bound = F.col("shared") + F.least("left", "after")
    alone = (met.where("g is null").where((NUM + DEN) * bound >= NUM * (F.col("n") + F.col("m")))
             .where("id <> b").select("id", "b"))
    pairs = (alone.union(opened(open_, heads)).select(F.col("id").alias("a"), "b").distinct().transform(held))
    second = verify(named, likely(pairs, heads))

    tops = components(links.union(second))
    best = reps.select("n", "fp", F.col("id").alias("rep")).join(tops, F.col("rep") == F.col("id"), "left").select(
        "n", "fp", F.coalesce("component", "rep").alias("component_id"))
    out = sigs.select("id", "n", "fp").join(best, ["n", "fp"], "left").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
    out = packed(out, rows * 32).checkpoint()      # the result: in the shared folder
    drop_stored(sigs, reps, heads)
    return out


def row_names(df: DataFrame, name: str = "_row") -> DataFrame:
    """``df`` with a 64-bit name that only rows which are equal in every column
    share.  Names are hashes of all columns and of which of them are null; where
    rows of different digests meet in a name (by chance, from some 10^9 rows on), those
    rows are named anew, until no two meet."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    parts = [p for c in columns for p in (c, c.isNull())]
    plain = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-"))
             for t in (F.to_json(F.struct(c)) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else c.cast("string")
                       for c, f in zip(columns, df.schema.fields))]
    digest = F.sha2(F.concat(*plain), 256)
    named = df.withColumn(name, F.xxhash64(*parts))
    for salt in range(1, 20):
        seen = named.select(name, digest.alias("d")).groupBy(name).agg(F.min("d").alias("a"), F.max("d").alias("b"))
        clash = seen.where("a <> b").select(F.col(name).alias("_clash")).transform(held)
        if not clash.head(1):
            return named
        named = (named.join(clash, F.col(name) == F.col("_clash"), "left")
                 .withColumn(name, F.when(F.col("_clash").isNull(), F.col(name)).otherwise(F.xxhash64(F.lit(salt), digest)))
                 .drop("_clash"))
    raise RuntimeError("rows could not be told apart by 64-bit names")


def one_of_each(df: DataFrame) -> DataFrame:
    """The rows with all their columns, one of each group of copies: the one of
    the smallest id (null ids last).

    Rows are named by their columns (``row_names``), not by id: rows of one
    id with different texts are documents of their own, and rows with a null id
    link like others.  Rows without words link with nothing and stay; rows that
    are equal in every column are one document, whatever their text."""
    columns = df.columns
    named = row_names(df)
    found = jaccard_classes(named, "_row")
    rows = named.groupBy("_row").agg(F.min("doc_id").alias("id"), F.count(F.lit(1)).alias("times"))
    # aggregated, not ranked: a large group is combined before the shuffle
    best = (rows.join(found.groupBy("doc_id").agg(F.min("component_id").alias("c")), F.col("_row") == F.col("doc_id"))
            .groupBy("c").agg(F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "_row", "times")).alias("s"))
            .select("s._row", "s.times").transform(held))
    equal = best.where("times > 1").select("_row")
    gone = rows.join(best.where("times = 1"), "_row", "left_anti").select("_row").transform(held)
    kept = named.join(_small(gone), "_row", "left_anti").select(*[F.col(f"`{c}`") for c in columns])
    if not equal.limit(1).count():
        return kept
    again = (named.join(_small(equal), "_row", "left_semi").groupBy("_row")
             .agg(F.first(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("s")).select("s.*"))
    return kept.unionByName(again)
