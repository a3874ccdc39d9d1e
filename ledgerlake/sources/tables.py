"""Batch table sources (S3, S4, S5, S7) and the transaction fixture projection.

All readers go through ``spark.read`` so Catalyst pushes filters and column
pruning into the Parquet scan.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.schemas import TRANSACTION_COLUMNS

log = logging.getLogger(__name__)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_table(spark: SparkSession, path: str, fmt: str = "parquet",
               merge_schema: bool = False) -> DataFrame:
    """S3: full scan of a (partitioned) table at ``path``.

    The record count of S3 is a separate action (``df.count()``) so callers
    decide when to pay for it; ``mergeSchema`` reconciles additive evolution.
    """
    reader = spark.read.format(fmt)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def load_catalog_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """Catalog table scan; identifiers are parameters, never constants."""
    return spark.table(f"`{database}`.`{table}`")


def sql_with_inputs(spark: SparkSession, query: str, inputs: dict[str, DataFrame]) -> DataFrame:
    """Run one SQL text over named DataFrames.

    Uses parameterised DataFrame references (``{alias}`` in the text) so no
    global temp view is created or overwritten.
    """
    return spark.sql(query, **inputs)


def register_partitioned_table(spark: SparkSession, database: str, table: str,
                               path: str, fmt: str = "parquet") -> DataFrame:
    """Catalog sync for a partitioned folder.

    Creates the external table once (schema from the files), then registers
    only partition folders not yet known.  Hidden files (``_``/``.`` prefix,
    e.g. ``_SUCCESS``, ``_delta_log``, ``.crc``) are skipped by Spark's file
    index; existing partitions are never dropped.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    ident = f"`{database}`.`{table}`"
    if not spark.catalog.tableExists(f"{database}.{table}"):
        spark.catalog.createTable(f"{database}.{table}", path=path, source=fmt)
    else:
        # schema changes are logged, never applied (the table keeps its schema)
        known = set(spark.table(ident).columns)
        found = set(spark.read.format(fmt).option("mergeSchema", "true").load(path).columns)
        if found - known:
            log.warning("table %s: files carry new columns %s; schema left unchanged",
                        ident, sorted(found - known))
    if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{table}")):
        spark.sql(f"MSCK REPAIR TABLE {ident} ADD PARTITIONS")
    return spark.table(ident)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, by the file system that holds it (any other
    failure raises)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


# ---------------------------------------------------------------------------
# Fixture: the 14-field transaction contract projected from ``events``.
# The text is valid in both Spark SQL and DuckDB, so the oracle uses it as is.
# Fixed values (planted defects and category / currency / country / card mixes).
# ---------------------------------------------------------------------------
TRANSACTION_PROJECTION = [
    ("event_id", "CASE WHEN event_id % 1009 = 0 THEN NULL ELSE concat('00000000-0000-4000-8000-', lpad(CAST(event_id AS VARCHAR(20)), 12, '0')) END"),
    ("event_timestamp", "CAST(ts AS TIMESTAMP)"),
    ("user_id", "concat('USR_', lpad(CAST(user_id AS VARCHAR(20)), 6, '0'))"),
    ("merchant_id", "concat('MER_', lpad(CAST(event_id % 500 + 1 AS VARCHAR(20)), 5, '0'))"),
    ("merchant_category", "CASE WHEN event_id % 701 = 0 THEN NULL WHEN event_id % 601 = 0 THEN 'crypto' WHEN (event_id * 37) % 100 < 22 THEN 'grocery' WHEN (event_id * 37) % 100 < 40 THEN 'retail' WHEN (event_id * 37) % 100 < 55 THEN 'restaurant' WHEN (event_id * 37) % 100 < 65 THEN 'electronics' WHEN (event_id * 37) % 100 < 74 THEN 'travel' WHEN (event_id * 37) % 100 < 82 THEN 'fuel' WHEN (event_id * 37) % 100 < 89 THEN 'entertainment' WHEN (event_id * 37) % 100 < 94 THEN 'healthcare' WHEN (event_id * 37) % 100 < 98 THEN 'subscription' ELSE 'atm_withdrawal' END"),
    ("amount", "CASE WHEN event_id % 809 = 0 THEN NULL WHEN event_id % 907 = 0 THEN value * 1000000 + 60000 WHEN event_id % 911 = 0 THEN -value ELSE value END"),
    ("currency", "CASE WHEN (event_id * 53) % 100 < 60 THEN 'USD' WHEN (event_id * 53) % 100 < 80 THEN 'EUR' WHEN (event_id * 53) % 100 < 90 THEN 'GBP' WHEN (event_id * 53) % 100 < 96 THEN 'CAD' ELSE 'AUD' END"),
    ("country_code", "CASE WHEN event_id % 503 = 0 THEN 'usa' WHEN (event_id * 71) % 100 < 45 THEN 'US' WHEN (event_id * 71) % 100 < 61 THEN 'GB' WHEN (event_id * 71) % 100 < 91 THEN 'CA' WHEN (event_id * 71) % 100 < 94 THEN 'BR' WHEN (event_id * 71) % 100 < 96 THEN 'NG' WHEN (event_id * 71) % 100 < 98 THEN 'RU' ELSE 'UA' END"),
    ("card_type", "CASE WHEN (event_id * 13) % 100 < 55 THEN 'credit' WHEN (event_id * 13) % 100 < 93 THEN 'debit' ELSE 'prepaid' END"),
    ("is_online", "event_type NOT IN ('view', 'error')"),
    ("device_type", "CASE WHEN event_type IN ('view', 'error') THEN 'pos_terminal' ELSE 'mobile' END"),
    ("ip_address", "CASE WHEN event_type IN ('view', 'error') THEN NULL ELSE concat('10.0.', CAST(user_id % 256 AS VARCHAR(20)), '.', CAST(event_id % 256 AS VARCHAR(20))) END"),
    ("_is_fraud_label", "(event_id * 7 + user_id) % 50 = 0"),
    ("terminal_id", "CAST(NULL AS VARCHAR(20))"),
]
assert [c for c, _ in TRANSACTION_PROJECTION] == TRANSACTION_COLUMNS


def transaction_select_sql(source: str = "events", extra: str = "") -> str:
    """The projection as SQL text (used by the oracle and by tests)."""
    cols = ",\n  ".join(f"{e} AS {c}" for c, e in TRANSACTION_PROJECTION)
    sep = ",\n  " if extra else ""
    return f"SELECT\n  {cols}{sep}{extra}\nFROM {source}"


def transactions_from_events(events: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Project ``events`` onto the transaction contract (a narrow, codegen'd
    projection: no shuffle).  ``keep`` carries extra source columns through."""
    exprs = [f"{e} AS {c}" for c, e in TRANSACTION_PROJECTION]
    return events.selectExpr(*exprs, *(keep or []))


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from_events(read_table(spark, sf_dir, "events"))
