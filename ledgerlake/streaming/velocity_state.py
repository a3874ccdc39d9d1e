"""X6, exact: trailing velocity per user as a stream.

Every event gets the count and the amount of its user's events in [t - w, t], as the
batch operator gives them (``operators.velocity``), whatever the order of arrival
inside the watermark.  An event waits until the watermark has passed its time: from
then on no event of its frame can come.  Users are dealt to ``USER_BUCKETS`` by hash,
and a bucket has one state, so that a batch makes a bounded number of Python calls
however many users it holds.  A bucket's state holds, of its users,

* the waiting events (bounded by the watermark's delay), and
* a ring of (time, amount) of those already answered that a later frame can still
  reach, the last w before the watermark,

so it is bounded by the rate times (w + delay).  A timer at the first waiting event
answers users that send nothing more, and another at the end of the last frame drops
a bucket's state.  Events behind the watermark are dropped by Spark and counted in
``numRowsDroppedByWatermark``.

Rows without user or time belong to no frame; they pass by with NULLs.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ledgerlake.operators.velocity import DEFAULT_MINUTES, DEFAULT_THRESHOLD

STATE = "ring binary, waiting binary"
#: states; their number is part of a checkpoint
USER_BUCKETS = 4096
#: columns of the work frame: time in microseconds and amount
AT, SUM = "_at", "_amount"


def framed(times: np.ndarray, known: np.ndarray, amounts: np.ndarray, at: np.ndarray,
           width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(events, known amounts, their sum) in [t - width, t] for each t of ``at``, of
    events sorted by time that hold each t.  Each frame is summed by itself, so a
    NaN or infinite amount outside a frame never touches it."""
    lo, hi = np.searchsorted(times, at - width, "left"), np.searchsorted(times, at, "right")
    before = np.concatenate([[0], np.cumsum(known)])
    padded = np.append(np.where(known, amounts, 0.0), 0.0)
    sums = np.add.reduceat(padded, np.stack([lo, hi], axis=1).ravel())[::2]
    return hi - lo, before[hi] - before[lo], sums


def by_user(users: pa.Array, at: np.ndarray, known: np.ndarray, amounts: np.ndarray, asked: int,
            width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``framed`` for the events from number ``asked`` on, each among its own user's."""
    who = np.asarray(users.dictionary_encode().indices)
    order = np.lexsort((at, who))
    ends = np.flatnonzero(np.diff(who[order])) + 1
    out = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64), np.zeros(len(at))
    for mine in np.split(order, ends):
        ask = mine[mine >= asked]
        if len(ask):
            for column, found in zip(out, framed(at[mine], known[mine], amounts[mine], at[ask], width)):
                column[ask] = found
    return tuple(column[asked:] for column in out)


def _pack(rows: pa.Table) -> bytes | None:
    if not len(rows):
        return None
    out = io.BytesIO()
    with pa.ipc.new_stream(out, rows.schema) as w:
        w.write_table(rows)
    return out.getvalue()


def _unpack(data: bytes | None) -> list[pa.Table]:
    return [] if data is None else [pa.ipc.open_stream(pa.BufferReader(bytes(data))).read_all()]


def velocity_exact(tx: DataFrame, minutes: int = DEFAULT_MINUTES, threshold: int = DEFAULT_THRESHOLD,
                   watermark: str = "10 minutes", user: str = "user_id", ts: str = "event_timestamp",
                   amount: str = "amount") -> DataFrame:
    """A stream of transactions -> every row plus ``velocity_count``,
    ``velocity_amount`` (2 dp) and ``velocity_alert``, in append mode."""
    from pyspark.sql.pandas.types import to_arrow_schema

    width = int(minutes) * 60 * 1_000_000
    columns = tx.columns
    # pandas frames know no difference between NaN and NULL: flags carry it
    floats = [f.name for f in tx.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    flags = [f"_nan_{i}" for i in range(len(floats))]
    work = tx.filter(F.col(ts).isNotNull() & F.col(user).isNotNull()).select(
        *columns, F.unix_micros(F.col(ts)).alias(AT),
        F.col(amount).cast("double").alias(SUM), F.col(amount).isNotNull().alias("_known"),
        *[F.coalesce(F.isnan(c), F.lit(False)).alias(g) for c, g in zip(floats, flags)],
        F.col(ts).alias("_event_time"), F.pmod(F.xxhash64(user), F.lit(USER_BUCKETS)).alias("_bucket"))
    carried = to_arrow_schema(T.StructType([f for f in work.schema.fields if f.name not in ("_event_time", "_bucket")]))
    in_ring = [user, AT, SUM, "_known"]
    out_schema = T.StructType([*tx.schema.fields, *[T.StructField(g, T.BooleanType()) for g in flags], T.StructField("_n", T.LongType()), T.StructField("_nn", T.LongType()),
                               T.StructField("_sum", T.DoubleType())])
    names = [f.name for f in out_schema.fields]

    def answer(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        ring, waiting = state.get if state.exists else (None, None)
        tables = _unpack(waiting)
        tables += [pa.Table.from_pandas(f[carried.names], schema=carried, preserve_index=False) for f in frames]
        passed = state.getCurrentWatermarkMs() * 1000
        rows = pa.concat_tables(tables) if tables else carried.empty_table()
        rows = rows.take(pa.array(np.argsort(np.asarray(rows[AT]), kind="stable")))
        ready = int(np.searchsorted(np.asarray(rows[AT], dtype=np.int64), passed, "right"))
        left = rows.slice(ready)
        held = pa.concat_tables([*_unpack(ring), rows.slice(0, ready).select(in_ring)])
        at = np.asarray(held[AT], dtype=np.int64)
        if ready:
            done = rows.slice(0, ready).to_pandas()
            done["_n"], done["_nn"], done["_sum"] = by_user(pa.concat_arrays(held[user].chunks), at, np.asarray(held["_known"], dtype=bool),
                                                            held[SUM].to_numpy(), len(held) - ready, width)
            yield done[names]
        keep = at > passed - width
        if not len(left) and not keep.any():
            if state.exists:
                state.remove()
            return
        state.update((_pack(held.filter(pa.array(keep))), _pack(left)))
        due = left[AT][0].as_py() if len(left) else int(at.max()) + width
        state.setTimeoutTimestamp(max(int(-(-due // 1000)), state.getCurrentWatermarkMs() + 1))

    answered = (work.withWatermark("_event_time", watermark).groupBy("_bucket")
                .applyInPandasWithState(answer, out_schema, STATE, "append", GroupStateTimeout.EventTimeTimeout))
    nan = F.lit(float("nan"))
    back = {c: F.when(F.col(g), nan.cast(tx.schema[c].dataType)).otherwise(F.col(c)).alias(c) for c, g in zip(floats, flags)}
    framed_rows = answered.select(*[back.get(c, F.col(c)) for c in columns], F.col("_n").alias("velocity_count"),
                                  F.when(F.col("_nn") > 0, F.coalesce(F.round("_sum", 2), nan)).alias("velocity_amount"),
                                  (F.col("_n") > threshold).alias("velocity_alert"))
    rest = tx.filter(F.col(ts).isNull() | F.col(user).isNull()).select(
        *columns, F.lit(None).cast("long").alias("velocity_count"), F.lit(None).cast("double").alias("velocity_amount"),
        F.lit(None).cast("boolean").alias("velocity_alert"))
    return framed_rows.unionByName(rest)
