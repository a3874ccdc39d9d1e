"""bronze/transaction rows -> silver rows.

One ``select`` (not a chain of ``withColumn``) so the analyzer sees a single
projection; the flags reference each other only through expressions, which
Catalyst's common-subexpression elimination evaluates once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import columns as X


def silver_columns(ingested_at: Column | None = None) -> list[Column]:
    invalid = X.dq_invalid_category()
    out_of_range = X.dq_amount_out_of_range()
    missing = X.dq_missing_required()
    return [
        X.event_date().alias("event_date"),
        X.event_hour().alias("event_hour"),
        X.is_high_risk_country().alias("is_high_risk_country"),
        invalid.alias("dq_invalid_category"),
        out_of_range.alias("dq_amount_out_of_range"),
        missing.alias("dq_missing_required"),
        X.dq_passed(invalid, out_of_range, missing).alias("dq_passed"),
        (ingested_at if ingested_at is not None else F.current_timestamp()).alias("_ingested_at"),
        X.pipeline_version().alias("_pipeline_version"),
    ]


def to_silver(df: DataFrame, ingested_at: Column | None = None,
              audit: bool = True) -> DataFrame:
    """Add the nine derived silver columns to every input column.

    ``ingested_at`` may be injected (tests, replays); ``audit=False`` leaves
    out the two audit columns for deterministic comparisons.
    """
    cols = silver_columns(ingested_at)
    if not audit:
        cols = cols[:-2]
    return df.select("*", *cols)
