"""Access paths over scored records (N4-N6), and J1 insert-if-absent.

N4 is a top-k: ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject,
which keeps n rows per task and merges them -- no full sort, no shuffle of
the table.  N5/N6 are filters pushed into the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def recent(signals: DataFrame, n: int, ts: str = "event_timestamp",
           key: str = "event_id") -> DataFrame:
    """The ``n`` most recent records (ties broken by key, both desc)."""
    return signals.orderBy(F.col(ts).desc_nulls_last(), F.col(key).desc_nulls_last()).limit(n)


def anomalies(signals: DataFrame, flag: str = "is_anomaly") -> DataFrame:
    """Flagged records only."""
    return signals.filter(F.col(flag) == F.lit(True))


def for_user(signals: DataFrame, user_id: str, column: str = "user_id") -> DataFrame:
    """Records of one user."""
    return signals.filter(F.col(column) == F.lit(user_id))


def append_absent(new: DataFrame, existing: DataFrame, key: str | list[str],
                  order: list[str] | None = None) -> DataFrame:
    """J1 (``ON CONFLICT (key) DO NOTHING``): rows of ``new`` whose key is not
    in ``existing``, one per key: the first by ``order`` (source position),
    ties by the row's own columns.  A primary key cannot be NULL: such rows are
    rejected, not inserted.

    The batch is reduced before the join by a combinable aggregate, so a key
    that repeats costs one row per task; the anti join carries no hint, and
    whichever way it runs the rows are the same.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in new.columns if c not in keys]
    first = [F.col(c).alias(f"_o{i}") for i, c in enumerate(order or [])]
    row = F.struct(*first, *[F.col(c) for c in rest])
    valid = new.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    if rest:
        one = valid.groupBy(*keys).agg(F.min(row).alias("_row")).select(
            *[F.col(k) if k in keys else F.col(f"_row.{k}").alias(k) for k in new.columns])
    else:
        one = valid.distinct()
    return one.join(existing.select(*keys), on=keys, how="left_anti").select(*new.columns)
