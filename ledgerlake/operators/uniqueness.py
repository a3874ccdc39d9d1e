"""A5 / E7 without shuffling the keys.

A grouped count moves every key to one place, 40 bytes a row for a table whose keys are
all different, as they should be.  Here a first pass moves a fingerprint of four bytes:

1. each task packs the 32-bit fingerprints of its keys by range of their hash, at most
   two of each value (more tell nothing);
2. each range finds the fingerprints that occur twice; a key that repeats is among them,
   and of the others about one in 2^32 / (keys of a range);
3. only rows with such a fingerprint are looked at again, and counted exactly by key.

So the result is that of the grouped count, and what is shuffled in full is the rows of
keys that (almost surely) repeat.  A key that fills a third of the table is two
fingerprints a task, and then one partial count a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: keys of one range (16 MB of fingerprints), and keys that a task packs at once
RANGE_KEYS, PACK_KEYS = 4_000_000, 1_000_000


def _prefix(keys: list[str], bits: int) -> Column:
    """Range number and fingerprint of a row's key, as one number."""
    return F.shiftrightunsigned(F.xxhash64(*[F.col(k) for k in keys]), 32 - bits)


def range_bits(rows: int, least: int) -> int:
    """Bits of the range number for so many rows."""
    return min(31, max(0, int(np.ceil(np.log2(max(least, rows / RANGE_KEYS, 1))))))


def suspects(df: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """(prefix): every range and fingerprint that occurs more than once."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            seen = np.sort(np.concatenate(held))
            third = np.zeros(len(seen), bool)
            third[2:] = seen[2:] == seen[:-2]
            seen = seen[~third]
            part = seen >> 32
            cuts = np.flatnonzero(np.diff(part, prepend=-1))
            packs = np.split((seen & 0xFFFFFFFF).astype(np.uint32), cuts[1:])
            return pa.RecordBatch.from_arrays([pa.array(part[cuts]), pa.array([p.tobytes() for p in packs], pa.binary())], names=["part", "prints"])

        for b in batches:
            held.append(b.column(0).to_numpy())
            size += b.num_rows
            if size >= PACK_KEYS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def twice(table: pa.Table) -> pa.Table:
        prints = np.sort(np.concatenate([np.frombuffer(x, np.uint32) for x in table["prints"].to_pylist()]))
        again = np.unique(prints[1:][prints[1:] == prints[:-1]]).astype(np.int64)
        return pa.table({"prefix": pa.array((np.int64(table["part"][0].as_py()) << 32) | again)})

    packed = df.select(_prefix(keys, bits).alias("p")).mapInArrow(pack, "part bigint, prints binary")
    return packed.groupBy("part").applyInArrow(twice, "prefix bigint")


def repeated_keys(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """(by, column, k): keys that occur more than once, with their exact counts.
    NULL keys are ignored."""
    keys = [*by, column]
    known = df.select(*keys).where(F.col(column).isNotNull())
    bits = range_bits(known.count(), df.sparkSession.sparkContext.defaultParallelism)
    found = suspects(known, keys, bits)
    again = known.withColumn("prefix", _prefix(keys, bits)).join(found, "prefix", "left_semi")
    return again.groupBy(*keys).agg(F.count(F.lit(1)).alias("k")).where("k > 1")


def uniqueness_by_fingerprint(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """The result of ``expectations.uniqueness``."""
    total = df.groupBy(*by).agg(F.count(column).alias("uq_nonnull")).where("uq_nonnull > 0")
    found = repeated_keys(df, column, by).groupBy(*by).agg(
        F.sum("k").alias("uq_dup_rows"), F.sum(F.col("k") - 1).alias("uq_excess_rows"))
    both = total.unionByName(found, allowMissingColumns=True)            # a row a group from either side
    return both.groupBy(*by).agg(*[F.max(c).alias(c) for c in ("uq_nonnull", "uq_dup_rows", "uq_excess_rows")]).fillna(
        0, subset=["uq_dup_rows", "uq_excess_rows"])
