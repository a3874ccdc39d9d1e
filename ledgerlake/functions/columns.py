"""Column expressions.

All are built-in Catalyst expressions: they stay inside whole-stage codegen
and never leave the JVM.  Three-valued logic is kept exactly: a NULL category
gives a NULL ``dq_invalid_category`` and therefore a NULL ``dq_passed``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.schemas import (AMOUNT_MAX, AMOUNT_MIN, HIGH_RISK_COUNTRIES,
                                PIPELINE_VERSION, VALID_CATEGORIES)


def c(name: str | Column) -> Column:
    return F.col(name) if isinstance(name, str) else name


# -- silver flags (P7-P13) ---------------------------------------------------
def event_date(ts="event_timestamp") -> Column:
    return F.to_date(c(ts))


def event_hour(ts="event_timestamp") -> Column:
    return F.hour(c(ts))


def is_high_risk_country(country="country_code") -> Column:
    return c(country).isin(*HIGH_RISK_COUNTRIES)


def dq_invalid_category(category="merchant_category") -> Column:
    return ~c(category).isin(*VALID_CATEGORIES)


def dq_amount_out_of_range(amount="amount") -> Column:
    # NaN sorts above every number in Spark, so NaN is out of range (TRUE).
    return (c(amount) < AMOUNT_MIN) | (c(amount) > AMOUNT_MAX)


def dq_missing_required(event_id="event_id", user_id="user_id", amount="amount") -> Column:
    return c(event_id).isNull() | c(user_id).isNull() | c(amount).isNull()


def dq_passed(invalid=None, out_of_range=None, missing=None) -> Column:
    invalid = dq_invalid_category() if invalid is None else c(invalid)
    out_of_range = dq_amount_out_of_range() if out_of_range is None else c(out_of_range)
    missing = dq_missing_required() if missing is None else c(missing)
    return ~(invalid | out_of_range | missing)


def pipeline_version() -> Column:
    return F.lit(PIPELINE_VERSION)


# -- conversions and helpers (P19) --------------------------------------------
def one_if(flag) -> Column:
    """1 when the flag is TRUE, else 0 (FALSE and NULL both give 0)."""
    return F.when(c(flag), 1).otherwise(0)


# -- masking and derived labels (P23, P25) -------------------------------------
def mask_ipv4(ip="ip_address") -> Column:
    """Keep the /24 network of an IPv4 address: a.b.c.d -> a.b.c.0.
    Non-IPv4 text is left unchanged; NULL stays NULL."""
    return F.regexp_replace(c(ip), r"^(\d{1,3}\.\d{1,3}\.\d{1,3})\.\d{1,3}$", "$1.0")


def card_presence(is_online="is_online") -> Column:
    """CNP (card not present) for online, CP otherwise, NULL when unknown."""
    return F.when(c(is_online), F.lit("CNP")).when(~c(is_online), F.lit("CP"))
