"""S6 / D3 as a stream: change messages kept as a keyed table.

Each micro-batch is parsed once and goes three ways: rejected messages, the change
log (``change_log``: cut by LSN, pruned by its manifest), and the keyed table
(``keyed_table``: only touched buckets are rewritten).  Log and rejected messages of
a batch are overwritten by its retry, and the table does not apply a batch twice.
Tombstone rows stay in the table (a late change never revives a deleted key);
``current_rows`` leaves them out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.operators import cdc
from ledgerlake.sources import files
from ledgerlake.streaming import change_log
from ledgerlake.streaming.keyed_table import KeyedTable

#: versions of the table that stay readable
KEEP_VERSIONS = 2


@dataclass(frozen=True)
class ChangePaths:
    log: str
    rejected: str
    table: str
    checkpoint: str
    buckets: int = 64


def keyed_table(row: T.StructType, key: list[str], paths: ChangePaths) -> KeyedTable:
    return KeyedTable(paths.table, row, tuple(key), paths.buckets)


def _parsed(messages: DataFrame, row: T.StructType, key: list[str], path: str) -> DataFrame:
    """The batch parsed once and stored: splits of its files are what later tasks read, where
    a cached batch would take the executors' memory with blocks as large as its input files.
    Only rejected messages keep their text."""
    parsed = cdc.parse_messages(messages, row, key)
    parsed = parsed.withColumn("raw_value", F.when(F.col("_reason").isNotNull(), F.col("raw_value")))
    parsed.write.options(**files.ROW_GROUPS).mode("overwrite").parquet(path)
    return messages.sparkSession.read.schema(parsed.schema).parquet(path)


def apply_batch(messages: DataFrame, batch_id: int, row: T.StructType, key: list[str],
                paths: ChangePaths, file_rows: int = change_log.FILE_ROWS) -> None:
    """One micro-batch: log, rejected messages, next version of the table."""
    spark = messages.sparkSession
    staged = f"{paths.log}/parsed/_batch_id={int(batch_id)}"
    try:
        parsed = _parsed(messages, row, key, staged)
        (cdc.rejected(parsed).write.mode("overwrite").parquet(f"{paths.rejected}/_batch_id={int(batch_id)}"))
        log = cdc.valid_changes(parsed.drop(*cdc.RAW_COLUMNS))
        change_log.append_stored(log, paths.log, batch_id, file_rows)
        table = keyed_table(row, key, paths)
        table.merge(spark, log, int(batch_id))
    finally:
        files.delete(spark, staged)
    table.vacuum(spark, KEEP_VERSIONS)


def start_change_stream(messages: DataFrame, row: T.StructType, key: list[str], paths: ChangePaths,
                        trigger: dict | None = None, file_rows: int = change_log.FILE_ROWS) -> StreamingQuery:
    """A stream of (key, value, kafka_offset) messages into the keyed table."""
    return (messages.writeStream
            .foreachBatch(lambda df, n: apply_batch(df, n, row, key, paths, file_rows))
            .option("checkpointLocation", paths.checkpoint)
            .trigger(**(trigger or {"processingTime": "30 seconds"})).start())


def current_rows(spark: SparkSession, row: T.StructType, key: list[str], paths: ChangePaths) -> DataFrame:
    """The latest version of the table without deleted rows."""
    return keyed_table(row, key, paths).rows(spark)


def log_schema(row: T.StructType, key: list[str]) -> T.StructType:
    """Type of the stored changes."""
    return T.StructType([*(T.StructField(k, row[k].dataType, True) for k in key),
                         T.StructField("op", T.StringType()), T.StructField("before", row), T.StructField("after", row),
                         T.StructField("lsn", T.LongType()), T.StructField("tx_id", T.LongType()),
                         T.StructField("table", T.StringType()), T.StructField("seq", T.LongType())])
