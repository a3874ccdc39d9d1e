"""Helpers shared by the operators of this subpackage: work tables in the
shared folder, vectorised word hashing over Arrow string buffers, connected
components over a table of links.
"""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import checkpoint_dir

#: bytes of a table below which a file of its own, or a task, is not worth while
PACK_BYTES = 4 << 20
#: bytes of text that one vectorised step works on; bounds a task's memory
BLOCK_BYTES = 1 << 19
#: the same for operators that keep many temporary arrays or tables beside it
SMALL_BLOCK = 1 << 18


# ---- work tables ------------------------------------------------------------

def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    and survives lost executors because the folder is shared."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def held(df: DataFrame) -> DataFrame:
    """``df`` computed once and its lineage cut, for the steps between: its rows lie on
    the disks of two executors.  ``checkpoint`` writes a file for each partition, and
    on a local folder Hadoop starts a ``chmod`` process from the executor for each file
    and its checksum: tens of thousands where tables are small and partitions many, and
    while one starts, the executor's memory counts twice."""
    return df.localCheckpoint(True, StorageLevel.DISK_ONLY_2)


def table_bytes(df: DataFrame) -> int:
    """Spark's estimate of a table's bytes: what its files have."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def packed(df: DataFrame, size: int | None = None) -> DataFrame:
    """``df`` in no more partitions than its bytes are worth (``PACK_BYTES`` each, two
    a core at least): fewer files and tasks where a small table lies in many splits."""
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    size = table_bytes(df) if size is None else size
    return df.coalesce(min(max(least, -(-size // PACK_BYTES)), (1 << 31) - 1))


def drop_stored(*frames: DataFrame) -> None:
    """Delete the folders behind ``stored`` tables that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for f in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(f).getParent()
            if "/llm/" in folder.toString():
                folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: rows of one Arrow batch where whole texts go to Python; a batch is held on both sides
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Smaller Arrow batches for this session, unless its own are smaller still:
    10,000 texts at once take tens of MB in the JVM and again in each worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


# ---- words and their hashes -------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 1 << 64)


def mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Finaliser: a bijection of 64-bit values that spreads every bit."""
    h = h + np.uint64((seed * _P + _P) % (1 << 64))
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


_BYTE = mix(np.arange(256, dtype=np.uint64), 77)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd base and of its inverse, modulo 2**64."""
    have = _powers.get("p")
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 1)
        for key, base in (("p", _P), ("i", _P_INV)):
            steps = np.full(size, np.uint64(base))
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers["p"], _powers["i"]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans [start, end) of ``data`` (sorted, not
    overlapping).  Works block by block, so that temporary arrays stay small
    however long the text is (a single span may exceed a block)."""
    out = np.empty(len(starts), np.uint64)
    i, n = 0, len(starts)
    while i < n:
        base = starts[i]
        j = max(i + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
        seg = data[base:ends[j - 1]]
        p, inv = _power_table(len(seg) + 1)
        c = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum(_BYTE[seg] * p[:len(seg)], out=c[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = mix((c[b] - c[a]) * inv[a] + (b - a).astype(np.uint64) * _M2)
        i = j
    return out


class Words:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a slice of texts, A-Z lower-cased.

    ``first[d]:first[d + 1]`` are the words of text d; ``hash`` their 64-bit
    hashes; ``start``/``end`` byte offsets into ``data``.
    """

    def __init__(self, texts: pa.Array, lower: bool = True):
        raw, offsets = string_bytes(texts)
        data = _LOWER[raw] if lower else raw
        offsets = offsets - offsets[0]
        word = ~_SPACE[data]
        begin = word.copy()
        begin[1:] &= ~word[:-1]
        edges = offsets[1:-1]
        edges = edges[edges < len(data)]
        begin[edges] = word[edges]
        finish = word.copy()
        finish[:-1] &= ~word[1:]
        inner = edges[edges > 0] - 1
        finish[inner] = word[inner]
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(begin)
        self.end = np.flatnonzero(finish) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.hash = span_hashes(data, self.start, self.end)


def string_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string array; nulls are empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    kind = np.int64 if wide else np.int32
    if len(texts) == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of at most ``most`` bytes of text (a longer
    single text is a slice of its own), so that memory follows the slice."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        col = batch.column(batch.schema.get_field_index(text))
        _, offsets = string_bytes(col)
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to
    give_back()


def give_back() -> None:
    """Hands freed memory back to the system at the end of a task: Python workers
    live on through the stages of a job, and with them what they once took."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):               # a C library without it
        pass


#: what workers keep for later tasks of one operator
_caches: list[dict] = []


def worker_cache() -> dict:
    """A dictionary that tasks of other operators may empty (``drop_caches``)."""
    _caches.append({})
    return _caches[-1]


def drop_caches() -> None:
    """Forget what earlier operators' tasks keep in this worker: it would stay in
    memory beside this one's."""
    held_back = any(_caches)
    for c in _caches:
        c.clear()
    if held_back:
        gc.collect()
        give_back()


# ---- connected components ---------------------------------------------------

def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(id, component): the smallest id reachable over ``links`` (a, b).

    Alternating star contraction: edges move to ever smaller neighbours until
    none changes.  A round has no more rows than links and collects no
    neighbourhood; rounds grow with the logarithm of the longest path.  Nodes without links do not appear.
    """
    edges = links.select(F.greatest("a", "b").cast("long").alias("u"),
                         F.least("a", "b").cast("long").alias("v")).where("u <> v").distinct().transform(held)
    before = None
    for _ in range(rounds):
        # large star: the upper end of an edge moves to the smallest neighbour of the lower.
        # held: joins of plain tables can be split where a hub is skewed
        both = edges.union(edges.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).where("m < u").select(F.col("u").alias("v"), "m").transform(held)
        large = edges.join(least, "v", "left").select("u", F.coalesce("m", "v").alias("v")).distinct().transform(held)
        # small star: lower neighbours of a node move to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("k")).where("k > 1").transform(held)
        small = (large.join(low, "u", "left")
                 .select(F.explode(F.array(F.struct(F.col("u"), F.coalesce("m", "v").alias("v")),
                                           F.struct(F.col("v").alias("u"), F.coalesce("m", "v").alias("v")))).alias("e"))
                 .select("e.u", "e.v").where("u <> v").distinct().transform(held))
        now = tuple(small.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        edges = small
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("connected components did not settle")
    tops = edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(tops)
