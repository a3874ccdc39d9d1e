"""The change log, cut by LSN, with a manifest that prunes its files.

A batch is written sorted by range of LSN, so each file holds a narrow span of it.
Beside the files stands one manifest row for each, (file, rows, first and last LSN),
made from the file's own LSN column.  A replay from some LSN looks at the manifest,
which is small, and reads only the files whose span overlaps; the files of everything
before are neither opened nor listed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources import files

MANIFEST = "file string, rows long, first_lsn long, last_lsn long, batch_id long"
#: changes of one log file
FILE_ROWS = 1_000_000


def append(changes: DataFrame, path: str, batch_id: int, file_rows: int = FILE_ROWS) -> None:
    """Write one batch (a retry overwrites exactly it): ``changes`` are stored, so that
    they are made once, then dealt out by range of LSN."""
    spark, batch_id = changes.sparkSession, int(batch_id)
    loose = f"{path}/loose/_batch_id={batch_id}"
    changes.write.options(**files.ROW_GROUPS).mode("overwrite").parquet(loose)
    append_stored(spark.read.schema(changes.schema).parquet(loose), path, batch_id, file_rows)
    files.delete(spark, loose)


def append_stored(stored: DataFrame, path: str, batch_id: int, file_rows: int = FILE_ROWS) -> None:
    """The same for changes that are cheap to read again (a range exchange reads its
    input twice, and they are counted)."""
    spark, batch_id = stored.sparkSession, int(batch_id)
    data = f"{path}/data/_batch_id={batch_id}"
    parts = max(1, -(-stored.count() // file_rows))
    stored.repartitionByRange(parts, "lsn").sortWithinPartitions("lsn", "seq").write.options(**files.ROW_GROUPS).mode("overwrite").parquet(data)
    spans = (spark.read.schema(stored.schema).parquet(data)
             .groupBy(F.regexp_extract("_metadata.file_path", "[^/]+$", 0).alias("name"))
             .agg(F.count(F.lit(1)).alias("rows"), F.min("lsn").alias("first_lsn"), F.max("lsn").alias("last_lsn")))
    (spans.select(F.concat(F.lit(f"data/_batch_id={batch_id}/"), "name").alias("file"), "rows", "first_lsn", "last_lsn",
                  F.lit(batch_id).cast("long").alias("batch_id"))
     .coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/_batch_id={batch_id}"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row for each file of the log."""
    return spark.read.schema(MANIFEST).option("recursiveFileLookup", "true").parquet(f"{path}/manifest")


def overlapping(spark: SparkSession, path: str, after: int, until: int | None = None) -> list[str]:
    """Files that hold changes with ``after`` < LSN <= ``until``."""
    spans = manifest(spark, path).where(F.col("last_lsn") > after)
    if until is not None:
        spans = spans.where(F.col("first_lsn") <= until)
    return sorted(r.file for r in spans.select("file").collect())         # names of files that will be read


def changes_since(spark: SparkSession, path: str, schema: T.StructType, after: int,
                  until: int | None = None) -> DataFrame:
    """Changes strictly after ``after`` (and up to ``until``), from the files that
    may hold any."""
    names = overlapping(spark, path, after, until)
    if not names:
        return spark.createDataFrame([], schema)
    out = spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names]).where(F.col("lsn") > after)
    return out if until is None else out.where(F.col("lsn") <= until)
