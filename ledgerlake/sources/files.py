"""Small driver-side file steps through the Hadoop FileSystem API: what a
manifest needs, on whatever store holds the tables."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

#: write options of tables whose rows are long.  A reader takes a column of a row group as
#: one buffer, and on a local store each thread that reads keeps a second one outside the
#: heap, as large as the largest it had: up to 128 MB with Parquet's own row groups
ROW_GROUPS = {"parquet.block.size": str(8 << 20)}


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; nothing where there is no folder."""
    fs, p = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.delete(p, True))


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    fs, p = _fs(spark, path)
    fs.setTimes(p, millis, -1)


def write_json(spark: SparkSession, path: str, value: dict) -> None:
    """A whole file or none: written beside, then renamed (readers look for the
    final name only)."""
    fs, p = _fs(spark, path)
    _, beside = _fs(spark, f"{path[:path.rindex('/')]}/_writing-{path[path.rindex('/') + 1:]}")
    out = fs.create(beside, True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(beside, p):
        raise OSError(f"could not rename onto {path}")


def read_json(spark: SparkSession, path: str) -> dict:
    fs, p = _fs(spark, path)
    source = fs.open(p)
    try:
        return json.loads(bytes(source.readAllBytes()).decode())
    finally:
        source.close()
