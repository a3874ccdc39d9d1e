"""Data contract: schemas, domain constants and thresholds."""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the upstream contract for identical results).
# ---------------------------------------------------------------------------
VALID_CATEGORIES = [
    "grocery", "electronics", "travel", "restaurant", "fuel",
    "healthcare", "entertainment", "retail", "subscription", "atm_withdrawal",
]
HIGH_RISK_COUNTRIES = ["NG", "RU", "UA", "BR"]
VALID_CURRENCIES = ["USD", "EUR", "GBP", "CAD", "AUD"]
AMOUNT_MIN = 0.01
AMOUNT_MAX = 50000.0
COUNTRY_CODE_PATTERN = r"^[A-Z]{2}$"
UUID_V4_PATTERN = r"^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"
PIPELINE_VERSION = "1.1.0"
# per-batch alert thresholds (level 1)
MAX_NULL_RATE = 0.01
MAX_BAD_AMOUNT_RATE = 0.01
MAX_INVALID_CAT_RATE = 0.001
MAX_FRAUD_RATE = 0.10
# run gate (level 2)
MIN_PASS_RATE = 0.95
# contract: overall null rate on required fields
MAX_REQUIRED_NULL_RATE = 0.01
# wire format: a zero byte, then a 4-byte schema id
HEADER_BYTES = 5
# quarantine retention in days
QUARANTINE_RETENTION_DAYS = 90
# ---------------------------------------------------------------------------

TRANSACTION_FIELDS = [
    ("event_id", T.StringType(), False),
    ("event_timestamp", T.TimestampType(), False),
    ("user_id", T.StringType(), False),
    ("merchant_id", T.StringType(), True),
    ("merchant_category", T.StringType(), True),
    ("amount", T.DoubleType(), True),
    ("currency", T.StringType(), True),
    ("country_code", T.StringType(), True),
    ("card_type", T.StringType(), True),
    ("is_online", T.BooleanType(), True),
    ("device_type", T.StringType(), True),
    ("ip_address", T.StringType(), True),
    ("_is_fraud_label", T.BooleanType(), True),
    ("terminal_id", T.StringType(), True),
]
TRANSACTION_COLUMNS = [n for n, _, _ in TRANSACTION_FIELDS]
REQUIRED_FIELDS = [n for n, _, nullable in TRANSACTION_FIELDS if not nullable]

# The schema Spark holds after decoding; nullability is checked by the quality
# rules, not by the type system (a NULL key must reach quarantine/flags).
TRANSACTION_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t, _ in TRANSACTION_FIELDS])

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("kafka_timestamp", T.TimestampType(), True),
    T.StructField("kafka_partition", T.IntegerType(), True),
    T.StructField("kafka_offset", T.LongType(), True),
    T.StructField("raw_bytes", T.BinaryType(), True),
])


GOLD_COLUMNS = [
    "event_date", "merchant_category", "total_transactions", "fraud_count",
    "fraud_rate_pct", "avg_amount", "max_amount", "total_amount",
    "online_count", "high_risk_country_count",
]


