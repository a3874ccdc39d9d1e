"""Merkle manifest of a document table: a leaf for each row, a tree for each
source, a tree over the sources, and for each row the proof that leads from its
leaf to the root.

A leaf's place in its source comes from bitmaps, not from a sort: every source
has a bitmap of its ids, kept as 64-bit words of which only those with a bit are
stored (``bit_or`` merges what tasks saw).  A directory holds the rows before
each word, level by level over 4,096 words, blocks of words, and so on, so that
no level gathers more than 4,096 rows in a group.  A row's place is the number
before its word plus the set bits below its own.

Levels are then reduced by place: ``BLOCK`` = 3^7 consecutive nodes form a block,
whose slot array one task fills by place and folds seven levels up; block
roots are the nodes of the next round.  On the way down each block gets the
siblings above it once, and its leaves' proofs are put together inside the task,
so proofs (kilobytes a row) are never shuffled.

Defined results: null columns count as ``-``; a null id comes before all others
of its source, a null source before all others; ids that occur in more rows
give a leaf for each row, ordered by the leaf (such rows, and only they, are
placed by a ranged sort); equal rows have equal leaves and differ in their
place; empty texts are values of no bytes; texts are hashed whole; further
columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import drop_stored, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: children of a node, levels of a block, and the nodes of a block
FAN, LEVELS = 3, 7
BLOCK = FAN ** LEVELS
#: bits of a word's number that one level of the directory covers
DIRECTORY_BITS = 12
#: bits of a word's number, and the word of null ids, below those of all 64-bit ids
WORD_BITS = 59
NULL_WORD = -(1 << 57) - 1


def leaf(fields: dict[str, Column] | None = None) -> Column:
    """Lowercase hex digest of a row's fields, each with its length in front."""
    parts = []
    for name in FIELDS:
        value = (fields or {}).get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tampered_text() -> Column:
    """The text without line feeds where 2 divides the id's crc32."""
    hit = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    return F.when(F.coalesce(hit, F.lit(False)), F.translate("text", "\n", "")).otherwise(F.col("text"))


# ---- places -----------------------------------------------------------------

def word_counts(leaves: DataFrame) -> DataFrame:
    """(group, word, bits, rows): the bitmaps of all groups."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), _bit())
    return leaves.groupBy("group", "word").agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("rows"))


def _bit() -> Column:
    """The id's bit in its word."""
    return F.coalesce(F.col("doc_id").bitwiseAND(F.lit(63)), F.lit(0)).cast("int")


def directory(words: DataFrame) -> DataFrame:
    """``words`` with ``before``, the rows of the group in smaller words, and ``n``,
    all rows of the group (known at the top, and handed down with the rest, so that
    no join is dealt by the group alone)."""
    ends = words.agg(F.min("word"), F.max("word")).first()
    levels = 1
    # up to one block for all words; negative and other words never share a prefix
    while ends[0] is not None and DIRECTORY_BITS * levels < WORD_BITS and (
            ends[0] >> DIRECTORY_BITS * levels) != (ends[1] >> DIRECTORY_BITS * levels):
        levels += 1
    # sums of the blocks of each level, from the words up
    sums = [words.select("group", F.col("word").alias("at"), "rows")]
    for _ in range(levels - 1):
        sums.append(sums[-1].groupBy("group", F.shiftright("at", DIRECTORY_BITS).alias("at")).agg(F.sum("rows").alias("rows")))
    before = None
    for level in reversed(sums):
        block = Window.partitionBy("group") if before is None else Window.partitionBy("group", F.shiftright("at", DIRECTORY_BITS))
        within = block.orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
        own = level.withColumn("own", F.coalesce(F.sum("rows").over(within), F.lit(0)))
        if before is None:                   # the top: one block for each group
            before = own.select("group", "at", F.col("own").alias("before"), F.sum("rows").over(block).alias("n"))
        else:
            above = before.withColumnRenamed("at", "up")
            before = (own.withColumn("up", F.shiftright("at", DIRECTORY_BITS)).join(above, ["group", "up"])
                      .select("group", "at", (F.col("before") + F.col("own")).alias("before"), "n"))
    return words.join(before.withColumnRenamed("at", "word"), ["group", "word"])


def ordered_places(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` with ``place``: its rows' numbers in the order of ``keys``, from a
    ranged sort and one count for each of its partitions."""
    def numbered(batches):
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(b.num_rows, part, np.int64)), pa.array(np.arange(n, n + b.num_rows))],
                names=[*b.schema.names, "part", "nth"])
            n += b.num_rows

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    rows = stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .mapInArrow(numbered, f"{fields}, part bigint, nth bigint"), "placed")
    parts = rows.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))        # a row for each partition
    first = parts.select("part", (F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).alias("first"))
    return rows.join(first, "part").withColumn("place", F.col("first") + F.col("nth")).drop("part", "nth", "first")


def placed_leaves(leaves: DataFrame) -> DataFrame:
    """``leaves`` (group, doc_id, leaf, tampered) with ``place`` in the group and
    its number of rows ``n``."""
    keyed = leaves.withColumn("word", F.coalesce(F.shiftright("doc_id", 6), F.lit(NULL_WORD)))
    words = stored(directory(word_counts(keyed)), "words")
    with_words = keyed.join(words, ["group", "word"])
    below = F.bitwise_not(F.call_function("shiftleft", F.lit(-1).cast("long"), _bit()))
    single = F.col("rows") == F.bit_count("bits")
    names = ["group", "doc_id", "leaf", "tampered", "n"]
    by_rank = with_words.where(single).select(
        *names, (F.col("before") + F.bit_count(F.col("bits").bitwiseAND(below))).alias("place"))
    if not words.where(~single).head(1):
        return by_rank
    # words with more rows than ids: order their rows, and count from the word's first
    repeated = ordered_places(with_words.where(~single).select(*names, "word", "before"), "group", "word", "doc_id", "leaf")
    first = repeated.groupBy("group", "word").agg(F.min("place").alias("first"))
    return by_rank.unionByName(repeated.join(first, ["group", "word"])
                               .select(*names, (F.col("before") + F.col("place") - F.col("first")).alias("place")))


# ---- levels -----------------------------------------------------------------

def _fold(slots: list[bytes], levels: int) -> list[list[bytes]]:
    """All levels of a block, its slots (hex digests) first."""
    all_levels = [slots]
    for _ in range(levels):
        slots = [hashlib.sha256(b"".join(slots[i:i + FAN])).hexdigest().encode() for i in range(0, len(slots), FAN)]
        all_levels.append(slots)
    return all_levels


def _levels(n: int) -> int:
    """Levels of a block in a tree level of ``n`` nodes: to its one root, or all."""
    k = 0
    while k < LEVELS and n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def _siblings(levels: list[list[bytes]], slot: int) -> list[tuple[list[bytes], list[bytes]]]:
    """For each level, what stands left and right of the slot's node in its run."""
    out = []
    for nodes in levels[:-1]:
        first = slot - slot % FAN
        out.append((nodes[first:slot], nodes[slot + 1:first + FAN]))
        slot //= FAN
    return out


_BLOCKS = "group string, block bigint, n bigint, ids array<bigint>, hashes array<string>, tampered array<string>, hash string"


def pack_blocks(nodes: DataFrame) -> DataFrame:
    """A row for each block of (group, place, n, doc_id, hash, tampered): slot
    arrays by place, and the block's root."""
    def pack(table: pa.Table) -> pa.Table:
        slot = np.asarray(table["place"]) % BLOCK
        by_slot = np.empty(len(slot), np.int64)
        by_slot[slot] = np.arange(len(slot))
        table = table.take(pa.array(by_slot))
        n = table["n"][0].as_py()
        hashes = table["hash"].to_pylist()
        top = _fold([h.encode() for h in hashes], _levels(n))[-1][0].decode()
        return pa.table({"group": [table["group"][0].as_py()], "block": [table["place"][0].as_py() // BLOCK], "n": [n],
                         "ids": [table["doc_id"].to_pylist()], "hashes": [hashes],
                         "tampered": [table["tampered"].to_pylist()], "hash": [top]},
                        schema=pa.schema([("group", pa.string()), ("block", pa.int64()), ("n", pa.int64()),
                                          ("ids", pa.list_(pa.int64())), ("hashes", pa.list_(pa.string())),
                                          ("tampered", pa.list_(pa.string())), ("hash", pa.string())]))

    keyed = nodes.withColumn("block", F.floor(F.col("place") / BLOCK))
    return keyed.groupBy("group", "block").applyInArrow(pack, _BLOCKS)


def _path_type() -> str:
    """Siblings from a node up: what stands left and right of it at each level."""
    return "array<struct<l:string,r:string>>"


def _down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """Paths of a round's nodes, (group, place, path, subroot), from its blocks' paths."""
    def run(batches):
        for b in batches:
            for row in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
                levels = _fold([h.encode() for h in row["hashes"]], _levels(row["n"]))
                for s in range(len(row["hashes"])):
                    own = [{"l": b"".join(x).decode(), "r": b"".join(y).decode()} for x, y in _siblings(levels, s)]
                    out.append((row["group"], row["block"] * BLOCK + s, own + row["path"], row["subroot"]))
                    if len(out) >= BLOCK:
                        yield flush()
        if out:
            yield flush()

    out: list = []
    kind = pa.list_(pa.struct([("l", pa.string()), ("r", pa.string())]))

    def flush():
        g, p, w, r = zip(*out)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(g, pa.string()), pa.array(p, pa.int64()), pa.array(w, kind), pa.array(r, pa.string())],
                                          names=["group", "place", "path", "subroot"])

    joined = blocks.select("group", "block", "n", "hashes").join(above, ["group", "block"])
    return joined.mapInArrow(run, f"group string, place bigint, path {_path_type()}, subroot string")


def tree(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(rounds, tops): the stored blocks of every round from the leaves up, and
    (group, n, hash) of each group's root."""
    rounds, tops = [], None
    while True:
        blocks = stored(pack_blocks(nodes), "blocks")
        rounds.append(blocks)
        ended = blocks.where(F.col("n") <= BLOCK).select("group", "hash")
        tops = ended if tops is None else tops.unionByName(ended)
        rest = blocks.where(F.col("n") > BLOCK)
        if not rest.head(1):
            return rounds, tops
        nodes = rest.select("group", F.col("block").alias("place"), F.ceil(F.col("n") / BLOCK).alias("n"),
                            F.lit(None).cast("long").alias("doc_id"), "hash", F.lit(None).cast("string").alias("tampered"))


def block_paths(rounds: list[DataFrame], top_paths: DataFrame) -> DataFrame:
    """(group, block, path, subroot) of the first round's blocks, from those of the
    groups' roots (group, path, subroot)."""
    paths = None
    for blocks in reversed(rounds):
        own = blocks.where(F.col("n") <= BLOCK).select("group", "block").join(top_paths, "group").select("group", "block", "path", "subroot")
        if paths is not None:
            own = own.unionByName(paths)
        if blocks is rounds[0]:
            return own
        paths = _down(blocks, own).withColumnRenamed("place", "block")


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of
    every row; ``folded_root`` starts from the leaf of the tampered row."""
    changed = leaf({"text": tampered_text()})
    leaves = stored(docs.select(F.coalesce(F.concat(F.lit("1"), "source"), F.lit("0")).alias("group"), "doc_id",
                                leaf().alias("leaf"), changed.alias("tampered")), "leaves")
    rounds, subroots = tree(placed_leaves(leaves).withColumnRenamed("leaf", "hash"))

    # the tree over the sources: one group, ordered by source
    no_id, none = F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("tampered")
    subroots = stored(ordered_places(subroots, "group"), "subroots")
    upper = subroots.select(F.lit("").alias("group"), "place", F.lit(subroots.count()).cast("long").alias("n"), no_id, "hash", none)
    upper_rounds, roots = tree(upper)
    start = roots.select("group", F.expr(f"cast(array() as {_path_type()})").alias("path"), none.alias("subroot"))
    above = _down(upper_rounds[0], block_paths(upper_rounds, start)) if upper_rounds else start
    top_paths = subroots.join(above.select("place", "path"), "place").select("group", F.col("hash").alias("subroot"), "path")

    root = roots.select("hash").first()                   # one row at most
    blocks = (rounds[0].drop("hash").join(block_paths(rounds, top_paths), ["group", "block"])
              .withColumn("root", F.lit(root.hash if root else None).cast("string")))
    out = stored(blocks.mapInArrow(_prove, "doc_id bigint, leaf string, subroot string, root string, "
                                           "proof_sha256 string, folded_root string, verified boolean"), "manifest")
    drop_stored(leaves, subroots, *rounds, *upper_rounds)
    return out


def _prove(batches):
    """The rows of each block, with their proofs and folded roots."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.string()) for c in
                        ("leaf", "subroot", "root", "proof_sha256", "folded_root")], ("verified", pa.bool_())])
    for b in batches:
        for row in (b.slice(i, 1).to_pylist()[0] for i in range(b.num_rows)):
            levels = _fold([h.encode() for h in row["hashes"]], _levels(row["n"]))
            above = [(x["l"].encode(), x["r"].encode()) for x in row["path"]]
            rest = b"".join(x + y for x, y in above)
            proofs, folded = [], []
            for s, start in enumerate(row["tampered"]):
                own = [(b"".join(x), b"".join(y)) for x, y in _siblings(levels, s)]
                proof = hashlib.sha256(b"".join(x + y for x, y in own))
                proof.update(rest)
                proofs.append(proof.hexdigest())
                h = start.encode()
                for x, y in (*own, *above):
                    h = hashlib.sha256(x + h + y).hexdigest().encode()
                folded.append(h.decode())
            k = len(proofs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(row["hashes"]), pa.array([row["subroot"]] * k),
                 pa.array([row["root"]] * k), pa.array(proofs), pa.array(folded),
                 pa.array([f == row["root"] for f in folded])], schema=schema)
