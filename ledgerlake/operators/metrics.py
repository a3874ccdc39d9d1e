"""Level-1 quality: batch metrics (A1, A2) and threshold alerts.

``batch_metrics`` is one grouped aggregate (partial + final hash aggregate);
``alerts`` turns each metrics row into alert rows with ``inline`` + filter,
a narrow operation on a table with one row per batch.

Rates are rounded to 4 places *before* being compared with the thresholds
(0.00104 -> 0.0010 does not alert against 0.001), as upstream does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import one_if
from ledgerlake.schemas import (MAX_BAD_AMOUNT_RATE, MAX_FRAUD_RATE,
                                MAX_INVALID_CAT_RATE, MAX_NULL_RATE)

RATE_COLUMNS = {
    "null_rate": "dq_missing_required",
    "bad_amount_rate": "dq_amount_out_of_range",
    "invalid_cat_rate": "dq_invalid_category",
    "pass_rate": "dq_passed",
    "fraud_rate": "_is_fraud_label",
}


def metric_aggregates() -> list:
    n = F.count(F.lit(1))
    out = [n.alias("records")]
    for name, flag in RATE_COLUMNS.items():
        # FALSE and NULL both count as 0 over count(*) (level-1 semantics)
        out.append(F.round(F.sum(one_if(flag)) / n, 4).alias(name))
    return out


def batch_metrics(silver: DataFrame, by: str | list[str] | None = None) -> DataFrame:
    """One row per batch with ``records`` and the five rounded rates.

    ``by`` names the batch key column(s) (``batch_id`` in a stream,
    ``event_date`` when a table stands in for batches).  With ``by=None``
    the whole input is one batch; an empty input yields no row (A1: an
    empty batch is skipped, never divided by zero).
    """
    keys = [by] if isinstance(by, str) else list(by or [])
    if keys:
        return silver.groupBy(*keys).agg(*metric_aggregates())
    return (silver.agg(*metric_aggregates())
            .filter(F.col("records") > 0))


def alerts(metrics: DataFrame, include_summary: bool = False) -> DataFrame:
    """Alert rows ``(<batch keys>, rule, severity, observed, threshold)``.

    L1 null_rate > 0.01, L2 bad_amount_rate > 0.01, L3 invalid_cat_rate >
    0.001 (critical); L4 fraud_rate > 0.10 or = 0.0 (warning); L5 the batch
    summary line (info), emitted only when ``include_summary``.
    """
    keys = [c for c in metrics.columns
            if c not in ("records", *RATE_COLUMNS.keys())]

    def rule(rid, severity, observed, threshold, fires):
        return F.struct(
            F.lit(rid).alias("rule"), F.lit(severity).alias("severity"),
            F.col(observed).cast("double").alias("observed"),
            F.lit(threshold).cast("double").alias("threshold"),
            fires.alias("fires"))

    rules = [
        rule("L1_null_rate", "critical", "null_rate", MAX_NULL_RATE,
             F.col("null_rate") > MAX_NULL_RATE),
        rule("L2_bad_amount_rate", "critical", "bad_amount_rate", MAX_BAD_AMOUNT_RATE,
             F.col("bad_amount_rate") > MAX_BAD_AMOUNT_RATE),
        rule("L3_invalid_cat_rate", "critical", "invalid_cat_rate", MAX_INVALID_CAT_RATE,
             F.col("invalid_cat_rate") > MAX_INVALID_CAT_RATE),
        rule("L4_fraud_rate", "warning", "fraud_rate", MAX_FRAUD_RATE,
             (F.col("fraud_rate") > MAX_FRAUD_RATE) | (F.col("fraud_rate") == 0.0)),
        rule("L5_batch_summary", "info", "records", None, F.lit(include_summary)),
    ]
    return (metrics
            .select(*keys, F.inline(F.array(*rules)))
            .filter(F.col("fires"))
            .drop("fires"))
