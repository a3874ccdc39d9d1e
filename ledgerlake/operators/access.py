"""Column-level access (P22), IP masking (P23), label stripping.

All are projections: Catalyst prunes the hidden columns out of the scan's
ReadSchema, so a blocked column is never even read from storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlake.functions.columns import mask_ipv4

PII_COLUMNS = ["ip_address"]
LABEL_COLUMNS = ["_is_fraud_label"]

# Role -> (tables it may read, columns it may not see).
ROLES = {
    "data-engineers": ({"bronze", "silver", "gold", "quarantine", "fraud_signals", "dq_run_log"}, []),
    "data-analysts": ({"silver", "gold"}, PII_COLUMNS),
    "ml-engineers": ({"silver"}, PII_COLUMNS),
}


def role_view(df: DataFrame, table: str, role: str) -> DataFrame:
    """The projection of ``table`` that ``role`` may see; refuses tables
    outside the role's list."""
    if role not in ROLES:
        raise PermissionError(f"unknown role {role!r}")
    tables, blocked = ROLES[role]
    if table not in tables:
        raise PermissionError(f"role {role!r} may not read table {table!r}")
    return df.select(*[c for c in df.columns if c not in blocked])


def mask_ip(df: DataFrame, column: str = "ip_address") -> DataFrame:
    """Replace the host byte of IPv4 addresses with 0 (/24 network)."""
    return df.withColumn(column, mask_ipv4(column))


def strip_label(df: DataFrame) -> DataFrame:
    """Remove the training label before data leaves for an external feed."""
    return df.drop(*LABEL_COLUMNS)
