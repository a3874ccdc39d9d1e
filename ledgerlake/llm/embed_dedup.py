"""Embedding near-duplicates: a navigable small-world graph per shard, every
shard searched for every vector, links verified by cosine, components united.

1. Equal vectors become one, with their count.
2. Vectors are dealt into shards of bounded size by a hash; a task builds each
   shard's graph, which is stored.
3. Blocks of vectors meet every shard's graph.  The beam starts at ``BEAM`` and
   doubles until an audit against brute force (``AUDIT`` vectors, more if few of
   them have links, and ``PROBES`` planted near-copies, compared with all) finds
   ``RECALL`` of the true links, as the mean over vectors, also over those outside
   large groups; if no beam does, blocks and shards are compared exactly.  A single query's beam also doubles
   while all it holds qualifies, so large groups are counted whole.
4. Similarities near the threshold or above are computed anew in double
   precision; a task returns each vector's link count, and of the links a
   spanning forest, so groups never expand into all their pairs.
5. Components over the forests, spread to the equal vectors.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components link with nothing and are components of their own; vectors of
different length do not link; repeated rows are vectors of their own; a row
with a null id links with nothing, has a null component and is not kept; an empty
table gives an empty table; only the id and embedding columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import components, drop_stored, mix, stored
from ledgerlake.llm.hnsw import Graph
from ledgerlake.session import checkpoint_dir

COSINE = 0.9
#: vectors in a shard at most (a graph of 64 dimensions then takes about 35 MB),
#: and shards at least
SHARD_ROWS, MIN_SHARDS = 65_536, 6
#: vectors in a block of queries, and ways into which a shard's blocks are dealt
BLOCK, WAYS = 2048, 4
BEAM, RECALL, AUDIT = 64, 0.99, 256
#: vectors audited at most, those with links (but few) that are enough, and planted
#: near-copies, which have a link however rare links are
AUDIT_MOST, ENOUGH, PROBES = 4096, 64, 128
#: single-precision similarities this close below the threshold are verified too
SLACK = 1e-4


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)          # keeps squares finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def distinct_vectors(df: DataFrame) -> DataFrame:
    """(rep, copies, dims, v): each usable vector once, named by its smallest id."""
    ok = df.where("v is not null and size(v) > 0 and id is not null").where(
        ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    ).where(F.exists("v", lambda x: x != 0))
    return ok.groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")).withColumn("dims", F.size("v"))


def build_graphs(vectors: DataFrame, shards: int) -> DataFrame:
    """(dims, shard, graph): one stored graph a shard (and vector length)."""

    def build(table: pa.Table) -> pa.Table:
        table = table.combine_chunks().sort_by("rep")
        rep = table["rep"].to_numpy()
        unit = _unit(_matrix(table["v"].combine_chunks()))
        chance = ((mix(rep.view(np.uint64), 9) >> np.uint64(11)).astype(np.float64) + 1) / 2.0 ** 53
        graph = Graph.build(unit.astype(np.float32), chance)
        raw = graph.to_bytes(rep=rep, copies=table["copies"].to_numpy(), unit=unit)
        return pa.table({"dims": table["dims"][:1], "shard": table["shard"][:1], "graph": pa.array([raw], pa.binary())})

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("rep"), F.lit(shards).cast("long")).cast("int"))
    return dealt.groupBy("dims", "shard").applyInArrow(build, "dims int, shard int, graph binary")


def query_blocks(vectors: DataFrame) -> DataFrame:
    """(dims, rep, v): the vectors in blocks of ``BLOCK`` (arrays of rows)."""

    def pack(batches):
        held: dict = {}
        for b in batches:
            for dims in np.unique(b.column(2).to_numpy()):
                part = b.filter(pa.compute.equal(b.column(2), int(dims)))
                for at in range(0, part.num_rows, BLOCK):
                    p = part.slice(at, BLOCK)
                    held.setdefault(int(dims), []).append((p.column(0).to_numpy(), _matrix(p.column(1))))
                    yield from flush(held, int(dims), False)
        for dims in list(held):
            yield from flush(held, dims, True)

    def flush(held, dims, end):
        parts = held[dims]
        if not parts or not end and sum(len(r) for r, _ in parts) < BLOCK:
            return
        rep, v = (np.concatenate(x) for x in zip(*parts))
        held[dims] = []
        yield pa.RecordBatch.from_pydict({"dims": pa.array([dims], pa.int32()), "rep": [rep.tobytes()],
                                          "v": [v.astype(np.float64).tobytes()]})

    return vectors.select("rep", "v", "dims").mapInArrow(pack, "dims int, rep binary, v binary")


def _roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links: (id, root) for ids that are not roots."""
    ids, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = ends[:len(a)], ends[len(a):]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    child = root != np.arange(len(ids))
    return ids[child], ids[root[child]]


def _exact(unit: np.ndarray, nodes: np.ndarray) -> list[np.ndarray]:
    """All nodes near each vector, by comparing with all."""
    return [np.flatnonzero(x) for at in range(0, len(unit), 64) for x in unit[at:at + 64] @ nodes.T >= COSINE - SLACK]


def search(blocks: DataFrame, graphs: DataFrame, shards: int, width: int | None, copies: bool = True) -> DataFrame:
    """(id, other, n): rows with ``n`` count a vector's links in one shard, with
    ``copies`` included; rows with ``other`` are the forest's links.  Without a
    beam, vectors are compared with the whole shard."""

    def run(batches):
        last, graph, got = None, None, None
        for b in batches:
            for i in range(b.num_rows):
                key = (b.column(0)[i].as_py(), b.column(1)[i].as_py())
                if key != last:
                    graph, got = Graph.from_bytes(b.column(4)[i].as_py())
                    last = key
                rep = np.frombuffer(b.column(2)[i].as_py(), np.int64)
                unit = _unit(np.frombuffer(b.column(3)[i].as_py(), np.float64).reshape(len(rep), -1))
                near = graph.within(unit.astype(np.float32), COSINE - SLACK, width) if width else _exact(unit, got["unit"])
                row = np.repeat(np.arange(len(rep)), [len(x) for x in near])
                node = np.concatenate(near).astype(np.int64)
                exact = np.concatenate([np.einsum("kd,kd->k", unit[row[at:at + 65536]], got["unit"][node[at:at + 65536]])
                                        for at in range(0, max(1, len(row)), 65536)])
                keep = (exact >= COSINE) & (got["rep"][node] != rep[row])
                row, node = row[keep], node[keep]
                n = np.bincount(row, got["copies"][node] if copies else None, len(rep)).astype(np.int64)
                u, r = _roots(rep[row], got["rep"][node]) if len(row) else (row, row)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([rep, u]), pa.int64()),
                    pa.concat_arrays([pa.nulls(len(rep), pa.int64()), pa.array(r, pa.int64())]),
                    pa.concat_arrays([pa.array(n), pa.nulls(len(u), pa.int64())])], names=["id", "other", "n"])

    asked = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).withColumn(
        "way", F.pmod(F.xxhash64("rep"), F.lit(WAYS).cast("long")).cast("int"))
    held = graphs.withColumn("way", F.explode(F.sequence(F.lit(0), F.lit(WAYS - 1))))
    met = asked.join(held, ["dims", "shard", "way"]).select("dims", "shard", "rep", "v", "graph")
    return met.mapInArrow(run, "id long, other long, n long")


def audit_counts(vectors: DataFrame, asked: list[tuple[int, np.ndarray]]) -> dict[int, int]:
    """True links of each asked vector (id, v), by comparing it with all vectors."""
    sent = vectors.sparkSession.sparkContext.broadcast(asked)

    def run(batches):
        total: dict = {}
        for b in batches:
            dims = b.column(2).to_numpy()
            for d in np.unique(dims):
                mine = [(r, v) for r, v in sent.value if len(v) == d]
                if not mine:
                    continue
                part = b.take(pa.array(np.flatnonzero(dims == d)))
                ids, q = np.array([r for r, _ in mine]), _unit(np.array([v for _, v in mine]))
                n = np.zeros(len(ids), np.int64)
                for at in range(0, part.num_rows, 1024):
                    p = part.slice(at, 1024)
                    hit = q @ _unit(_matrix(p.column(1))).T >= COSINE
                    n += (hit & (ids[:, None] != p.column(0).to_numpy()[None, :])).sum(1)
                for r, k in zip(ids.tolist(), n.tolist()):
                    total[r] = total.get(r, 0) + k
        yield pa.RecordBatch.from_pydict({"id": pa.array(list(total), pa.int64()), "n": pa.array(list(total.values()), pa.int64())})

    rows = vectors.select("rep", "v", "dims").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return {r.id: r.n for r in rows.collect() if r.n}


def planted(asked: list[tuple[int, np.ndarray]], lowest: int) -> list[tuple[int, np.ndarray]]:
    """Near-copies (cosine 0.95) of the first vectors, under ids of their own."""
    rng, out = np.random.default_rng(3), []
    for k, (_, v) in enumerate(asked[:PROBES]):
        unit = _unit(v[None, :])[0]
        side = rng.normal(size=len(unit))
        side -= (side @ unit) * unit
        length = np.sqrt(side @ side)
        if len(unit) > 1 and length > 0:
            out.append((lowest - 1 - k, 0.95 * unit + np.sqrt(1 - 0.95 ** 2) * side / length))
    return out


def reached(true: dict[int, int], found: dict[int, int]) -> bool:
    """Whether the mean recall over vectors suffices, also over those outside large groups."""
    share = {i: found.get(i, 0) / n for i, n in true.items()}
    few = [share[i] for i, n in true.items() if n <= BEAM]
    return all(np.mean(x) >= RECALL for x in (list(share.values()), few) if x)


def audited_beam(vectors: DataFrame, graphs: DataFrame, shards: int) -> int | None:
    """The beam that passes the audit; None if none does."""
    spark, drawn = vectors.sparkSession, AUDIT
    while True:
        rows = vectors.select("rep", "v").orderBy(F.xxhash64("rep", F.lit(5)), "rep").limit(drawn).collect()
        asked = [(r.rep, np.array(r.v, np.float64)) for r in rows]
        true = audit_counts(vectors, asked)
        if len(rows) < drawn or drawn >= AUDIT_MOST or sum(n <= BEAM for n in true.values()) >= ENOUGH:
            break
        drawn = AUDIT_MOST
    if not asked:
        return BEAM
    lowest = vectors.agg(F.min("rep")).first()[0]
    probes = planted(asked, max(lowest, PROBES - (1 << 63) + 1))
    true |= audit_counts(vectors, probes)
    sample = spark.createDataFrame([(r, v.tolist(), len(v)) for r, v in asked + probes if r in true],
                                   "rep long, v array<double>, dims int")
    blocks, width = query_blocks(sample).checkpoint(), BEAM
    while true and width < SHARD_ROWS:
        got = search(blocks, graphs, shards, width, copies=False).where("n is not null").groupBy("id").agg(F.sum("n").alias("n"))
        if reached(true, {r.id: r.n for r in got.collect()}):
            return width
        width *= 2
    return None if true else BEAM


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``df``."""
    checkpoint_dir(df.sparkSession)
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("v"))
    vectors = stored(distinct_vectors(rows), "vectors")
    shards = max(MIN_SHARDS, -(-vectors.count() // SHARD_ROWS))
    graphs = stored(build_graphs(vectors, shards), "graphs")

    width = audited_beam(vectors, graphs, shards)

    hits = stored(search(query_blocks(vectors), graphs, shards, width), "hits")
    counts = hits.where("n is not null").groupBy("id").agg(F.sum("n").alias("near"))
    tops = components(hits.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")))
    known = (vectors.select("v", "copies", F.col("rep").alias("id")).join(counts, "id", "left").join(tops, "id", "left")
             .select("v", (F.col("copies") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "id").alias("component_id")).checkpoint())
    out = rows.join(known, "v", "left").select(
        F.col("id").alias("vec_id"), F.when(F.col("id").isNull(), 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
    out = out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))).checkpoint()
    drop_stored(vectors, graphs, hits)
    return out
