"""Velocity (N3): per-user count and amount over a trailing interval.

Choice (nothing upstream specifies it): trailing ``minutes`` per ``user_id``,
frame [t - w, t] inclusive (SQL RANGE semantics: same-time events are
peers), count of events and sum of amounts; ``velocity_alert`` when the
count exceeds ``threshold``.

Plan, built for a user that holds a third of the table:
* Partitioning.  A plain ``Window.partitionBy(user)`` puts all of a user's
  events in one task.  Time is cut into buckets of width w and the window is
  partitioned by (user, bucket): every frame [t - w, t] of an event in bucket
  b lies in buckets b-1 and b, so each partition holds the bucket's own
  events plus a narrow *context* copy (user, bucket, time, amount) of the
  previous bucket's events, shifted forward by w.  ``split`` = m narrows
  this further to sub-buckets of w/m, with the sub-buckets wholly inside a
  frame entering as pre-aggregated summary rows.
* Frames.  Spark evaluates a sliding RANGE frame by re-aggregating the
  buffered frame for every row, O(n k) for k events per window.  Only
  growing frames are used instead (incremental, O(1) per row):
      count(t) = own rows with time <= t
               + context rows with shifted time >= t
  (the second grows from the other end), and the same for amounts: a dense
  user costs two sorts, not k^2.  Nothing is subtracted, so an amount outside
  a frame (NaN, infinite, very large) never touches that frame's sum.
* Rows with a NULL user or time belong to no window; they go around it and
  never meet in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_MINUTES = 10
DEFAULT_THRESHOLD = 3


def velocity(tx: DataFrame, minutes: int = DEFAULT_MINUTES,
             threshold: int = DEFAULT_THRESHOLD, user: str = "user_id",
             ts: str = "event_timestamp", amount: str = "amount",
             split: int = 1, partitions: int | None = None) -> DataFrame:
    """Every input row plus ``velocity_count``, ``velocity_amount`` (2 dp)
    and ``velocity_alert``.  Rows with a NULL time or user get NULLs.

    ``split`` = m cuts each w-bucket into m sub-buckets of width g = w/m.
    The frame [t - w, t] of an event in sub-bucket j is: own rows of j up to
    t, the rows of sub-bucket j-m at or after t - w (a shifted context copy),
    and sub-buckets j-m+1 .. j-1 whole, which enter as m-1 pre-aggregated
    summary rows (count, sum, non-null count) from a combinable aggregate.
    A partition then holds 2g of one user's events instead of 2w; m = 1 is
    the plain bucket plan (no summaries).

    ``partitions`` deals the windows to that many tasks, each of which holds and sorts
    its rows; a caller gives it in proportion to the input, so that a task's memory
    does not grow with the table.  By default the session's shuffle partitions.
    """
    m = max(1, int(split))
    g_us = int(minutes) * 60 * 1_000_000 // m
    w_us = g_us * m
    if w_us != int(minutes) * 60 * 1_000_000:
        raise ValueError("split must divide the window into whole microseconds")
    cols = tx.columns
    timed = F.col(ts).isNotNull() & F.col(user).isNotNull()
    untimed = tx.filter(~timed).select(*cols, F.lit(None).cast("long").alias("velocity_count"),
                                       F.lit(None).cast("double").alias("velocity_amount"),
                                       F.lit(None).cast("boolean").alias("velocity_alert"))
    tx = tx.filter(timed)
    t = F.unix_micros(F.col(ts))
    j = F.floor(t / g_us)
    own = tx.select(*cols, F.col(user).alias("_u"), t.alias("_axis"), j.alias("_b"),
                    F.lit("own").alias("_kind"), F.col(amount).cast("double").alias("_amt"),
                    F.lit(1).cast("long").alias("_cnt"),
                    F.col(amount).isNotNull().cast("long").alias("_nn"))
    ctx = tx.select(F.col(user).alias("_u"), (t + w_us).alias("_axis"), (j + m).alias("_b"),
                    F.lit("ctx").alias("_kind"), F.col(amount).cast("double").alias("_amt"),
                    F.lit(1).cast("long").alias("_cnt"),
                    F.col(amount).isNotNull().cast("long").alias("_nn"))
    rows = own.unionByName(ctx, allowMissingColumns=True)
    if m > 1:
        # whole sub-buckets inside the frame, pre-aggregated per (user, sub-bucket)
        per_bucket = (tx.groupBy(F.col(user).alias("_u"), j.alias("_j"))
                      .agg(F.count(F.lit(1)).alias("_cnt"),
                           F.sum(F.col(amount).cast("double")).alias("_amt"),
                           F.count(F.col(amount)).alias("_nn")))
        summ = per_bucket.select(
            "_u", F.explode(F.sequence(F.col("_j") + 1, F.col("_j") + (m - 1))).alias("_b"),
            F.lit("sum").alias("_kind"), "_cnt", "_amt", "_nn")
        rows = rows.unionByName(summ, allowMissingColumns=True)

    if partitions:
        rows = rows.repartition(int(partitions), "_u", "_b")
    part = Window.partitionBy("_u", "_b")
    upto = part.orderBy("_axis").rangeBetween(Window.unboundedPreceding, 0)
    since = part.orderBy(F.col("_axis").desc()).rangeBetween(Window.unboundedPreceding, 0)
    k = F.col("_kind")
    is_own, is_ctx, is_sum = k == "own", k == "ctx", k == "sum"
    nn_row = F.col("_nn")

    def total(flag, v, frame):
        return F.coalesce(F.sum(F.when(flag, v)).over(frame), F.lit(0))

    def total_d(flag, v, frame):
        return F.coalesce(F.sum(F.when(flag, v)).over(frame), F.lit(0.0))

    def framed(agg, v):
        return agg(is_own, v, upto) + agg(is_ctx, v, since) + agg(is_sum, v, part)

    count, amt_n = framed(total, F.col("_cnt")), framed(total, nn_row)
    scored = rows.select(*cols, "_kind", count.alias("_n"), amt_n.alias("_nn2"),
                         framed(total_d, F.col("_amt")).alias("_s"))
    return (scored.filter(F.col("_kind") == "own")
            .select(*cols, F.col("_n").alias("velocity_count"),
                    F.when(F.col("_nn2") > 0, F.round(F.col("_s"), 2)).alias("velocity_amount"),
                    (F.col("_n") > threshold).alias("velocity_alert"))
            .unionByName(untimed))


def velocity_windows(tx: DataFrame, size: str = "10 minutes", slide: str = "1 minute",
                     user: str = "user_id", ts: str = "event_timestamp",
                     amount: str = "amount") -> DataFrame:
    """Hopping-window variant (the batch twin of the streaming X6): count and
    amount per (user, window).

    In batch, rows are first combined per (user, slide): a window is a run of
    whole slides, so only those few pane rows, not the events, multiply into
    the windows that hold them.  A stream, or a size that is no multiple of the
    slide, aggregates the windows directly (combinable, bounded state)."""
    n, total = F.count(F.lit(1)), F.sum(F.col(amount))
    rows, at = tx, F.col(ts)
    if not tx.isStreaming and _whole_slides(tx, size, slide):
        rows = (tx.groupBy(F.col(user), F.window(F.col(ts), slide).alias("pane"))
                .agg(n.alias("_n"), total.alias("_s")).select(user, F.col("pane.start").alias("_t"), "_n", "_s"))
        n, total, at = F.sum("_n"), F.sum("_s"), F.col("_t")
    return (rows.groupBy(F.col(user), F.window(at, size, slide).alias("window"))
            .agg(n.alias("velocity_count"), F.round(total, 2).alias("velocity_amount"))
            .select(user, F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "velocity_count", "velocity_amount"))


def _whole_slides(df: DataFrame, size: str, slide: str) -> bool:
    """Whether ``size`` is a multiple of ``slide`` (two constants)."""
    a, b = (f"unix_micros(timestamp '1970-01-01' + interval {x})" for x in (size, slide))
    return df.sparkSession.sql(f"SELECT {a} % {b} = 0").first()[0]
