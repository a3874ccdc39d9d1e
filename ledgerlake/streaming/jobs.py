"""Structured Streaming: bronze / silver / quarantine / alerts in ONE query.

Upstream runs two independent queries over one topic (the source is read
and decoded twice and their first offsets can differ) and appends in
``foreachBatch`` without a batch id, so a retried batch duplicates rows.
Here (K1-K3, K7, K9, X1-X3, X5):

* one source, decoded once (``mapInArrow`` inside the streaming plan);
* optional exact de-duplication on ``event_id`` at the silver sink (X5);
* one ``foreachBatch`` that persists the batch once and writes bronze,
  silver, quarantine and alert rows, each partitioned by ``_batch_id``
  under dynamic partition overwrite -- a replayed batch id rewrites exactly
  its own partitions, so the sinks are exactly-once with the checkpoint;
* per-batch metrics are collected as one row (bounded) and alerts are rows.
"""

from __future__ import annotations

import logging
import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlake.functions import wire
from ledgerlake.operators import metrics as ME
from ledgerlake.operators import quarantine as QU
from ledgerlake.operators.silver import to_silver
from ledgerlake.sources import files
from ledgerlake.streaming.evolution import write_evolving

log = logging.getLogger(__name__)

DEFAULT_TRIGGER = {"processingTime": "30 seconds"}


@dataclass(frozen=True)
class Paths:
    bronze: str
    silver: str
    quarantine: str
    alerts: str
    checkpoint: str
    signals: str | None = None


def _write_partitioned(df: DataFrame, path: str, batch_id: int, by: list[str]) -> None:
    (df.withColumn("_batch_id", F.lit(int(batch_id)))
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by, "_batch_id").parquet(path))


METRIC_COLUMNS = ["records", *ME.RATE_COLUMNS]
METRIC_SCHEMA = "records bigint, " + ", ".join(f"{c} double" for c in ME.RATE_COLUMNS)


def _log_alerts(batch_id: int, m: dict) -> None:
    """K7 log lines from the observed metrics (the rows are written too)."""
    log.info("batch %s records=%s pass_rate=%s fraud_rate=%s null_rate=%s bad_amount_rate=%s",
             batch_id, m["records"], m["pass_rate"], m["fraud_rate"], m["null_rate"],
             m["bad_amount_rate"])
    for rate, limit in (("null_rate", ME.MAX_NULL_RATE), ("bad_amount_rate", ME.MAX_BAD_AMOUNT_RATE),
                        ("invalid_cat_rate", ME.MAX_INVALID_CAT_RATE)):
        if m[rate] is not None and m[rate] > limit:
            log.critical("ALERT batch %s: %s %s above %s", batch_id, rate, m[rate], limit)
    f = m["fraud_rate"]
    if f is not None and (f > ME.MAX_FRAUD_RATE or f == 0.0):
        log.warning("WARNING batch %s: unusual fraud rate %s", batch_id, f)


def drop_seen(good: DataFrame, silver_path: str, batch_id: int,
              horizon_days: int = 0) -> DataFrame:
    """X5, exact: drop rows whose ``event_id`` an earlier batch already wrote
    to silver, and repeats inside the batch.  Nothing is dropped for being
    late.  A redelivered event carries its original event time, so only the
    silver partitions of the batch's own ``event_date`` values (each widened
    by ``horizon_days`` earlier days) are probed: the dates stay a table whose
    semi join prunes partitions at run time, and only the ``event_id`` column
    is read.  The batch's own ``_batch_id`` partition is excluded so a retried
    batch is not de-duplicated against its own earlier attempt.  Rows without
    a key are kept (they carry ``dq_missing_required``)."""
    from ledgerlake.operators.signals import append_absent
    from ledgerlake.sources.tables import path_exists
    spark = good.sparkSession
    keyed = good.filter(F.col("event_id").isNotNull())
    unkeyed = good.filter(F.col("event_id").isNull())
    order = [c for c in ("kafka_partition", "kafka_offset") if c in good.columns]
    if not path_exists(spark, silver_path):              # first batch
        return append_absent(keyed, keyed.select("event_id").limit(0), "event_id", order).unionByName(unkeyed)
    days = F.sequence(F.lit(0), F.lit(int(horizon_days)))
    dates = (keyed.select(F.to_date("event_timestamp").alias("d")).distinct()
             .select(F.explode(F.transform(days, lambda k: F.date_sub("d", k))).alias("d")).distinct())
    seen = spark.read.parquet(silver_path).filter(F.col("_batch_id") != F.lit(int(batch_id)))
    seen = seen.join(dates, F.col("event_date").eqNullSafe(F.col("d")), "left_semi").select("event_id")
    return append_absent(keyed, seen, "event_id", order).unionByName(unkeyed)


def first_deliveries(decoded: DataFrame, within: str = "2 days", clock: str | None = None) -> DataFrame:
    """X5 with bounded state: a stream of decoded rows without redelivered events.

    An accepted row's key is its ``event_id``; any other row (rejected, or without
    an id) is its own position, so a rejected message never stands for a good one.
    The state holds one key each for ``within`` after its first delivery and no
    more, and no table is read, so a batch costs the same at any hour of the day.

    The watermark runs on ``clock``, the time of arrival (by default the batch's own
    time), not on the event time: an event that arrives late is kept whatever its
    age.  What the horizon promises is exact: an event delivered again within
    ``within`` of its first delivery is dropped, later ones are not.
    """
    accepted = F.col("_reason").isNull() & F.col("event_id").isNotNull()
    key = F.when(accepted, F.concat(F.lit("id:"), "event_id")).otherwise(
        F.concat(F.lit("at:"), F.coalesce(F.col("kafka_partition").cast("string"), F.lit("-")), F.lit(":"),
                 F.coalesce(F.col("kafka_offset").cast("string"), F.lit("-"))))
    arrived = F.current_timestamp() if clock is None else F.col(clock)
    return (decoded.withColumns({"_delivery": key, "_arrived": arrived}).withWatermark("_arrived", within)
            .dropDuplicatesWithinWatermark(["_delivery"]).drop("_delivery", "_arrived"))


class QualityGateError(RuntimeError):
    """A critical level-1 alert stopped the batch before silver was written."""


def process_batch(decoded: DataFrame, batch_id: int, paths: Paths,
                  scorer=None, dedupe_horizon_days: int | None = None,
                  gate_critical: bool = False, evolving: bool = False) -> None:
    """K2 + K7 + K9 body of one micro-batch (also callable in batch mode).
    With ``dedupe_horizon_days`` silver is de-duplicated on ``event_id``
    exactly (``drop_seen``); bronze keeps every decoded row.

    With ``evolving`` bronze and silver have a schema log: a batch may bring new
    columns (``evolution``; read such layers with ``evolution.read_layer``).

    Alerts are rows and never block by default (as upstream).  With
    ``gate_critical`` the metrics are computed *before* the silver write and
    a critical alert raises ``QualityGateError`` after its row was written:
    silver and quarantine of that batch are not, and the batch is not
    committed, so it is replayed once the cause is fixed (T7's optional gate)."""
    write = write_evolving if evolving else _write_partitioned
    decoded = decoded.persist()
    try:
        # A1: the batch size is observed during the bronze write (no separate
        # emptiness job); an empty batch writes no rows and stops here.
        seen = Observation(f"batch_rows_{batch_id}")
        good = wire.accepted(decoded.observe(seen, F.count(F.lit(1)).alias("rows")))
        write(good, paths.bronze, batch_id, [])
        if not seen.get.get("rows"):
            return
        if dedupe_horizon_days is not None:
            good = drop_seen(good, paths.silver, batch_id, dedupe_horizon_days)
        silver = to_silver(good)
        if gate_critical:
            fired = ME.alerts(ME.batch_metrics(silver)).filter(F.col("severity") == "critical").persist()
            critical = fired.collect()                   # <= 3 rows
            if critical:
                _write_partitioned(fired, paths.alerts, batch_id, [])     # the evidence stays
                raise QualityGateError(
                    f"batch {batch_id}: " + ", ".join(f"{r.rule}={r.observed}" for r in critical))
        # L1-L5 metrics are observed while silver is written (no extra pass)
        obs = Observation(f"batch_metrics_{batch_id}")
        write(silver.observe(obs, *ME.metric_aggregates()), paths.silver, batch_id, ["event_date"])
        q = QU.quarantined(decoded)
        QU.write_quarantine(q, paths.quarantine, batch_id)
        m = obs.get                                      # one row, as a dict
        if m.get("records"):
            spark = decoded.sparkSession
            metrics = spark.createDataFrame([tuple(m[c] for c in METRIC_COLUMNS)],
                                            METRIC_SCHEMA)
            alert_rows = ME.alerts(metrics, include_summary=True)
            _write_partitioned(alert_rows, paths.alerts, batch_id, [])
            _log_alerts(batch_id, m)
        if scorer is not None and paths.signals:     # X7: scoring in the same batch
            _write_partitioned(scorer(silver), paths.signals, batch_id, [])
    finally:
        decoded.unpersist()


def decoded_stream(envelopes: DataFrame, schemas, decode_partitions: int | None = None,
                   reader: str | dict = wire.TRANSACTION_SCHEMA_JSON) -> DataFrame:
    """Decode a streaming envelope DataFrame.  Nothing is dropped here:
    redelivered events are removed at the silver sink (``drop_seen``), after
    routing, so a rejected message never suppresses a good one and no row is
    lost for being late.

    ``decode_partitions`` deals each micro-batch round-robin over that many
    tasks before the Python decode, for sources with fewer partitions than
    cores (a few topic partitions, one file per trigger).  For Kafka the
    source option ``minPartitions`` does the same without a shuffle.
    """
    if decode_partitions:
        envelopes = envelopes.repartition(int(decode_partitions))
    return wire.decode(envelopes, schemas, reader=reader)


def start_stream(envelopes: DataFrame, schemas, paths: Paths,
                 trigger: dict | None = None, scorer=None, query_name: str | None = None,
                 decode_partitions: int | None = None,
                 dedupe_horizon_days: int | None = None,
                 gate_critical: bool = False, dedupe_within: str | None = None,
                 reader: str | dict = wire.TRANSACTION_SCHEMA_JSON, evolving: bool = False) -> StreamingQuery:
    """S1/S2 envelope stream -> all layers, one query, one checkpoint.

    Redelivered events are dropped from silver against the stored table
    (``dedupe_horizon_days``, any distance back, reads the day's ids), or from all
    layers by a state of ``dedupe_within`` (``first_deliveries``, reads no table).

    ``trigger`` is passed to ``DataStreamWriter.trigger`` (X1), e.g.
    ``{"processingTime": "30 seconds"}`` or ``{"availableNow": True}``.
    """
    dec = decoded_stream(envelopes, schemas, decode_partitions, reader)
    if dedupe_within is not None:
        dec = first_deliveries(dec, dedupe_within)
    w = (dec.writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, paths, scorer,
                                                     dedupe_horizon_days, gate_critical, evolving))
         .option("checkpointLocation", paths.checkpoint)
         .trigger(**(trigger or DEFAULT_TRIGGER)))
    if query_name:
        w = w.queryName(query_name)
    return w.start()


def await_all(spark: SparkSession, timeout: int | None = None) -> None:
    """Block until ANY query stops (a dead query is never unnoticed).
    Spark returns at once if a query already ended since the last
    ``spark.streams.resetTerminated()``."""
    spark.streams.awaitAnyTermination(timeout) if timeout else spark.streams.awaitAnyTermination()


def velocity_stream(tx: DataFrame, size: str = "10 minutes", slide: str = "1 minute",
                    watermark: str = "10 minutes", ts: str = "event_timestamp") -> DataFrame:
    """Per-user velocity as a watermarked hopping-window aggregation;
    state is bounded by the watermark; output in append mode when a window
    closes."""
    from ledgerlake.operators.velocity import velocity_windows
    return velocity_windows(tx.withWatermark(ts, watermark), size, slide, ts=ts)


def read_table_merged(spark: SparkSession, path: str) -> DataFrame:
    """K3: read a layer written across schema versions (additive columns)."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def write_time_ordered(df: DataFrame, path: str, ts: str, slices: int) -> None:
    """Backfill helper: land ``df`` as ``slices`` files in event-time order.

    One range exchange and one parallel write; the files are then given
    modification times in the order of their ranges, because a file source hands
    files to micro-batches by modification time.  Replaying history this way keeps
    event time monotone across batches, so nothing falls behind a watermark.  A
    store that keeps no modification times of its own (object stores ignore the
    call) needs a landing folder per slice instead.
    """
    spark = df.sparkSession
    before = set(files.list_names(spark, path))
    df.repartitionByRange(max(1, int(slices)), ts).sortWithinPartitions(ts).write.mode("append").parquet(path)
    landed = [n for n in files.list_names(spark, path) if n not in before and n.endswith(".parquet")]
    now = int(time.time() * 1000)
    for k, name in enumerate(landed):                 # part-00000, part-00001, ..
        files.set_modified(spark, f"{path}/{name}", now + (k - len(landed)) * 1000)


def slices_for(spark: SparkSession, path: str, least: int, slice_bytes: int = 128 << 20) -> int:
    """How many landing files an input of this size is dealt to."""
    return max(least, -(-files.folder_bytes(spark, path) // slice_bytes))
