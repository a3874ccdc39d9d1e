"""A keyed table that is kept up to date without rewriting it.

Rows lie in key-hash buckets; a manifest per version says which write holds each
bucket:

    table/data/version=5/bucket=17/part-*.parquet
    table/manifest/version-00000000000000000005.json

A merge reads and rewrites only the buckets that its changes touch, under a folder
of its own version, and becomes visible with its manifest, which is written last and
whole.  So

* bytes read and written grow with the touched buckets, not with the table;
* a merge that dies between buckets leaves no trace for readers, and its retry
  overwrites its own folder and ends in the same state;
* a merge whose manifest is there is done: repeating it does nothing;
* a reader of an older version keeps its files until ``vacuum``.

The number of buckets is fixed when the table is made (it is in the manifest): a
bucket is what one task rewrites, so some 100 to 500 MB each.  A key is one row, so
a key with a third of all changes makes no bucket larger; its changes are reduced
to one row a task before the shuffle (``cdc.latest_per_key``).

Tombstones stay in the table, so a late change never revives a deleted key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import cdc
from ledgerlake.sources import files


@dataclass(frozen=True)
class KeyedTable:
    """``row`` is the type of the rows' images, ``key`` its key fields."""

    path: str
    row: T.StructType
    key: tuple[str, ...]
    buckets: int = 64

    @property
    def schema(self) -> T.StructType:
        """Key first, then the other fields, the position of the last change and
        whether it was a delete."""
        fields = [*(self.row[k] for k in self.key), *(f for f in self.row.fields if f.name not in self.key)]
        return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields]
                            + [T.StructField("_lsn", T.LongType(), True), T.StructField("_deleted", T.BooleanType(), True)])

    # ---- manifests ----------------------------------------------------------------
    def _manifest_path(self, version: int) -> str:
        return f"{self.path}/manifest/version-{version:020d}.json"

    def versions(self, spark: SparkSession) -> list[int]:
        """Committed versions."""
        return [int(n[len("version-"):-len(".json")]) for n in files.list_names(spark, f"{self.path}/manifest")
                if n.startswith("version-") and n.endswith(".json")]

    def manifest(self, spark: SparkSession, version: int) -> dict:
        return files.read_json(spark, self._manifest_path(version))

    def _latest(self, spark: SparkSession, at: int | None) -> dict:
        known = [v for v in self.versions(spark) if at is None or v <= at]
        return self.manifest(spark, known[-1]) if known else {"version": -1, "count": self.buckets, "buckets": {}}

    def _folder(self, version: int, bucket: int) -> str:
        return f"{self.path}/data/version={version}/bucket={bucket}"

    # ---- reading ------------------------------------------------------------------
    def _bucket(self, count: int) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.row[k].dataType) for k in self.key]), F.lit(count)).cast("int")

    def _read(self, spark: SparkSession, held: dict[str, int], only: list[int] | None = None) -> DataFrame:
        wanted = held if only is None else {str(b): held[str(b)] for b in only if str(b) in held}
        if not wanted:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*[self._folder(v, int(b)) for b, v in sorted(wanted.items())])

    def rows(self, spark: SparkSession, version: int | None = None, keys: list[tuple] | None = None,
             tombstones: bool = False) -> DataFrame:
        """The table as of ``version`` (the latest by default).  With ``keys`` only
        their buckets are read (a bounded list of literals, as a lookup gives)."""
        now = self._latest(spark, version)
        only = None
        if keys is not None:
            kind = T.StructType([T.StructField(k, self.row[k].dataType, True) for k in self.key])
            wanted = spark.createDataFrame(list(keys), kind)
            only = [r.b for r in wanted.select(self._bucket(now["count"]).alias("b")).distinct().collect()]
        out = self._read(spark, now["buckets"], only)
        if keys is not None:
            out = out.join(F.broadcast(wanted), list(self.key), "left_semi")
        return out if tombstones else out.filter(~F.col("_deleted")).drop("_lsn", "_deleted")

    # ---- writing ------------------------------------------------------------------
    def merge(self, spark: SparkSession, changes: DataFrame, version: int) -> dict:
        """Apply parsed, valid ``changes`` as ``version``; the manifest of it.

        ``version`` is the micro-batch's number: a number that is committed already
        is not applied again, whatever came after it."""
        if version in self.versions(spark):
            return self.manifest(spark, version)
        before = self._latest(spark, version)
        count = before["count"]
        present = " AND ".join(f"`{k}` IS NOT NULL" for k in self.key)
        # the batch as one row a key, written once: everything below reads it
        staged = f"{self.path}/staged/version={version}"
        (cdc.latest_per_key(changes.filter(present), list(self.key)).withColumn("bucket", self._bucket(count))
         .write.options(**files.ROW_GROUPS).mode("overwrite").parquet(staged))
        latest = spark.read.parquet(staged)
        touched = sorted(r.bucket for r in latest.select("bucket").distinct().collect())      # at most ``count`` numbers
        if touched:
            merged = cdc.merge_latest(self._read(spark, before["buckets"], touched), latest, list(self.key))
            (merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
             .withColumn("bucket", self._bucket(count)).repartition("bucket")
             .write.options(**files.ROW_GROUPS).mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/data/version={version}"))
        now = {"version": version, "count": count, "buckets": before["buckets"] | {str(b): version for b in touched},
               "touched": len(touched), "bytes": files.folder_bytes(spark, f"{self.path}/data/version={version}")}
        files.write_json(spark, self._manifest_path(version), now)
        files.delete(spark, staged)
        return now

    def vacuum(self, spark: SparkSession, keep: int = 2) -> int:
        """Drop all but the last ``keep`` versions: their manifests, and the buckets
        that only they hold.  Returns how many buckets went."""
        known = self.versions(spark)
        gone, kept = known[:-keep], known[-keep:]
        if not gone:
            return 0
        held = {(b, v) for n in kept for b, v in self.manifest(spark, n)["buckets"].items()}
        stale = {(b, v) for n in gone for b, v in self.manifest(spark, n)["buckets"].items()} - held
        for n in gone:                       # manifests first: no reader finds a version without its files
            files.delete(spark, self._manifest_path(n))
        for b, v in stale:
            files.delete(spark, self._folder(v, int(b)))
        for v in {v for _, v in stale} - {v for _, v in held}:
            files.delete(spark, f"{self.path}/data/version={v}")
        return len(stale)
