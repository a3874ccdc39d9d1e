"""Named analytic queries A9-A13 over silver.

Each is one grouped aggregate (partial + final) whose group count is tiny
(days, categories, 24 hours, 2-3 card-presence values), so the exchange is
negligible at any input size and hot groups are pre-aggregated map-side.
Fraud analytics read only rows that passed the quality flags; the quality
trend (A13) reads every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.columns import card_presence
from ledgerlake.operators.metrics import metric_aggregates


def _passed(silver: DataFrame, passed_only: bool) -> DataFrame:
    return silver.filter(F.col("dq_passed") == F.lit(True)) if passed_only else silver


def _fraud_aggs(with_amounts: bool = True) -> list:
    aggs = [
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.col("_is_fraud_label").cast("int")).alias("fraud_count"),
        F.round(F.avg(F.col("_is_fraud_label").cast("double")) * 100, 3).alias("fraud_rate_pct"),
    ]
    if with_amounts:
        aggs += [F.round(F.avg("amount"), 2).alias("avg_amount"),
                 F.round(F.sum("amount"), 2).alias("total_amount")]
    return aggs


def fraud_rate(silver: DataFrame, by: str | None = None, passed_only: bool = True) -> DataFrame:
    """Fraud rate overall (``by=None``) or per ``by`` (e.g. event_date)."""
    df = _passed(silver, passed_only)
    if by:
        return df.groupBy(by).agg(*_fraud_aggs(False))
    return df.agg(*_fraud_aggs(False))


def by_category(silver: DataFrame, passed_only: bool = True) -> DataFrame:
    """A10: fraud and amounts per merchant category."""
    return _passed(silver, passed_only).groupBy("merchant_category").agg(*_fraud_aggs())


def by_hour(silver: DataFrame, passed_only: bool = True) -> DataFrame:
    """Fraud and amounts per hour of day (UTC)."""
    return _passed(silver, passed_only).groupBy("event_hour").agg(*_fraud_aggs())


def cnp_split(silver: DataFrame, passed_only: bool = True) -> DataFrame:
    """Card-not-present (online) vs card-present; unknown kept apart."""
    return (_passed(silver, passed_only)
            .groupBy(card_presence().alias("card_presence"))
            .agg(*_fraud_aggs()))


def dq_trend(silver: DataFrame) -> DataFrame:
    """Per-day quality trend over all rows (records and the five rates)."""
    return silver.groupBy("event_date").agg(*metric_aggregates())
