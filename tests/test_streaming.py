"""Streaming = batch, restart, idempotent replay, dedupe, velocity stream."""

from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake.functions import wire
from ledgerlake.operators.silver import to_silver
from ledgerlake.operators.velocity import velocity_windows
from ledgerlake.plans.registry import REGISTRY_V1, land_envelopes, stream_paths
from ledgerlake.schemas import ENVELOPE_SCHEMA
from ledgerlake.sources.kafka import envelope_from_events
from ledgerlake.sources.tables import read_table
from ledgerlake.streaming import jobs as JB


def _source(spark, landing):
    return (spark.readStream.schema(ENVELOPE_SCHEMA)
            .option("maxFilesPerTrigger", 1).parquet(landing))


def _run(spark, landing, paths, **kw):
    q = JB.start_stream(_source(spark, landing), REGISTRY_V1, paths,
                        trigger={"availableNow": True}, **kw)
    q.awaitTermination()
    assert q.exception() is None
    return q


def _batch_silver(spark):
    env = envelope_from_events(read_table(spark, SF001, "events"))
    return to_silver(wire.accepted(wire.decode(env, REGISTRY_V1))).drop("_ingested_at")


def test_stream_equals_batch_and_restart(spark):
    root, paths = stream_paths(spark, "t-stream")
    land_envelopes(spark, SF001, f"{root}/landing")
    _run(spark, f"{root}/landing", paths)
    silver = spark.read.parquet(paths.silver).drop("_ingested_at", "_batch_id")
    want = _batch_silver(spark).select(*silver.columns)
    assert silver.exceptAll(want).count() == 0 and want.exceptAll(silver).count() == 0
    batches = spark.read.parquet(paths.silver).select("_batch_id").distinct().count()
    assert batches == 4                                   # one file per trigger
    # restart from the checkpoint: nothing new, nothing duplicated
    _run(spark, f"{root}/landing", paths)
    assert spark.read.parquet(paths.silver).count() == silver.count()
    q = spark.read.parquet(paths.quarantine)
    assert q.count() > 0 and set(r.reason for r in q.select("reason").distinct().collect()) >= {
        "null_value", "too_short", "bad_magic", "unknown_schema", "decode_error"}
    alerts = spark.read.parquet(paths.alerts)
    assert alerts.filter("rule = 'L5_batch_summary'").count() == 4


def test_replayed_batch_id_overwrites(spark):
    root, paths = stream_paths(spark, "t-replay")
    env = envelope_from_events(read_table(spark, SF001, "events"))
    dec = wire.decode(env, REGISTRY_V1)
    JB.process_batch(dec, 0, paths)
    n = spark.read.parquet(paths.silver).count()
    JB.process_batch(dec, 0, paths)                      # crash + retry of batch 0
    assert spark.read.parquet(paths.silver).count() == n
    JB.process_batch(dec, 1, paths)                      # a genuinely new batch adds
    assert spark.read.parquet(paths.silver).count() == 2 * n


def test_dedupe_empty_file_and_extra_column(spark):
    root, paths = stream_paths(spark, "t-dedupe")
    landing = f"{root}/landing"
    env = envelope_from_events(read_table(spark, SF001, "events"), defects=False)
    env.coalesce(1).write.parquet(f"{landing}/a")
    # redelivery of the first 100 offsets of partition 0, an empty file, and
    # a file from a producer that added a column
    env.filter("kafka_partition = 0 AND kafka_offset < 100").coalesce(1).write.parquet(f"{landing}/b")
    env.limit(0).coalesce(1).write.parquet(f"{landing}/c")
    env.filter("kafka_partition = 1 AND kafka_offset < 5").withColumn("extra", F.lit("x")) \
       .coalesce(1).write.parquet(f"{landing}/d")
    src = (spark.readStream.schema(ENVELOPE_SCHEMA).option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", 1).parquet(landing))
    q = JB.start_stream(src, REGISTRY_V1, paths, trigger={"availableNow": True},
                        dedupe_horizon_days=0)
    q.awaitTermination()
    assert q.exception() is None
    silver = spark.read.parquet(paths.silver)
    ids = silver.filter("event_id IS NOT NULL")
    assert ids.count() == ids.select("event_id").distinct().count()
    assert "extra" not in silver.columns


def test_velocity_stream_equals_batch(spark):
    root, paths = stream_paths(spark, "t-vel")
    tx = _batch_silver(spark).select("user_id", "event_timestamp", "amount")
    JB.write_time_ordered(tx, f"{root}/tx", "event_timestamp", 3)
    src = (spark.readStream.schema(tx.schema).option("maxFilesPerTrigger", 1)
           .parquet(f"{root}/tx"))
    out = JB.velocity_stream(src, "10 minutes", "5 minutes", watermark="1 hour")
    q = (out.writeStream.outputMode("append").format("parquet")
         .option("path", f"{root}/vel").option("checkpointLocation", f"{root}/_vck")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(f"{root}/vel")
    want = velocity_windows(tx, "10 minutes", "5 minutes")
    assert sum(p["stateOperators"][0]["numRowsDroppedByWatermark"] for p in q.recentProgress) == 0
    # append mode emits a window once the watermark passes it; the last hour
    # of data stays in state until newer events arrive
    wm = q.lastProgress["eventTime"]["watermark"].replace("T", " ").rstrip("Z")
    cut = F.lit(wm).cast("timestamp")
    closed = want.filter(F.col("window_end") <= cut)
    got_closed = got.filter(F.col("window_end") <= cut)
    assert got.count() == got_closed.count() and closed.count() > 0
    assert got_closed.exceptAll(closed).count() == 0 and closed.exceptAll(got_closed).count() == 0


def test_sink_dedupe_keeps_late_rows(spark):
    root, paths = stream_paths(spark, "t-sinkdedupe")
    landing = f"{root}/landing"
    env = envelope_from_events(read_table(spark, SF001, "events"), defects=False)
    late_cut = "2024-01-20"
    env.filter(f"kafka_timestamp >= '{late_cut}'").coalesce(1).write.parquet(f"{landing}/a")
    # a late file: the older half of the month arrives after the newer half
    env.filter(f"kafka_timestamp < '{late_cut}'").coalesce(1).write.parquet(f"{landing}/b")
    # and a redelivery of some already-seen messages
    env.filter(f"kafka_timestamp >= '{late_cut}' AND kafka_partition = 0").coalesce(1) \
       .write.parquet(f"{landing}/c")
    src = (spark.readStream.schema(ENVELOPE_SCHEMA).option("recursiveFileLookup", "true")
           .option("maxFilesPerTrigger", 1).parquet(landing))
    q = JB.start_stream(src, REGISTRY_V1, paths, trigger={"availableNow": True},
                        dedupe_horizon_days=0)
    q.awaitTermination()
    assert q.exception() is None
    silver = spark.read.parquet(paths.silver)
    want = wire.accepted(wire.decode(env, REGISTRY_V1))
    assert silver.count() == want.count()                        # late rows kept
    keyed = silver.filter("event_id IS NOT NULL")
    assert keyed.count() == keyed.select("event_id").distinct().count()
    assert spark.read.parquet(paths.bronze).count() > silver.count()   # bronze keeps all


def test_crash_between_sinks_then_restart_is_exactly_once(spark, monkeypatch):
    root, paths = stream_paths(spark, "t-crash")
    land_envelopes(spark, SF001, f"{root}/landing", files=2)
    real = JB.QU.write_quarantine
    calls = {"n": 0}

    def crash_on_second_batch(q, path, batch_id=None):
        calls["n"] += 1
        if calls["n"] == 2:                     # bronze + silver of batch 1 already written
            raise RuntimeError("simulated crash")
        return real(q, path, batch_id)

    monkeypatch.setattr(JB.QU, "write_quarantine", crash_on_second_batch)
    q = JB.start_stream(_source(spark, f"{root}/landing"), REGISTRY_V1, paths,
                        trigger={"availableNow": True})
    try:
        q.awaitTermination()
    except Exception:  # noqa: BLE001 -- the query is expected to fail
        pass
    assert q.exception() is not None
    monkeypatch.setattr(JB.QU, "write_quarantine", real)
    q2 = JB.start_stream(_source(spark, f"{root}/landing"), REGISTRY_V1, paths,
                         trigger={"availableNow": True})
    q2.awaitTermination()
    assert q2.exception() is None
    env = envelope_from_events(read_table(spark, SF001, "events"))
    dec = wire.decode(env, REGISTRY_V1)
    assert spark.read.parquet(paths.bronze).count() == wire.accepted(dec).count()
    assert spark.read.parquet(paths.silver).count() == wire.accepted(dec).count()
    from ledgerlake.operators import quarantine as QU
    assert spark.read.parquet(paths.quarantine).count() == QU.quarantined(dec).count()


def test_optional_quality_gate_blocks_silver(spark):
    import pytest
    from conftest import SF01
    root, paths = stream_paths(spark, "t-gate")
    env = envelope_from_events(read_table(spark, SF01, "events"))
    dec = wire.decode(env, REGISTRY_V1)
    # the whole table as one batch alerts on invalid categories (L3)
    with pytest.raises(JB.QualityGateError):
        JB.process_batch(dec, 0, paths, gate_critical=True)
    import os
    assert not os.path.exists(paths.silver.replace("file:", ""))
    JB.process_batch(dec, 0, paths)                    # default: alert rows only
    alerts = spark.read.parquet(paths.alerts)
    assert alerts.filter("rule = 'L3_invalid_cat_rate'").count() == 1


def test_write_time_ordered_slices_are_monotone(spark):
    import glob
    import os
    root, _ = stream_paths(spark, "t-slices")
    tx = _batch_silver(spark).select("event_id", "event_timestamp")
    JB.write_time_ordered(tx, f"{root}/tx", "event_timestamp", 3)
    files = sorted(glob.glob(f"{root.replace('file:', '')}/tx/*.parquet"), key=os.path.getmtime)
    assert len(files) == 3
    bounds = [spark.read.parquet(f).agg(F.min("event_timestamp"), F.max("event_timestamp"),
                                        F.count(F.lit(1))).first() for f in files]
    assert sum(b[2] for b in bounds) == tx.count()
    assert all(bounds[i][1] <= bounds[i + 1][0] for i in range(2))


def test_change_stream_replay_and_tombstones(spark):
    from ledgerlake.sources.changes import ORDER_KEY, ORDER_ROW
    from ledgerlake.streaming import changes as CS
    root, _ = stream_paths(spark, "t-changes")
    paths = CS.ChangePaths(f"{root}/log", f"{root}/rej", f"{root}/table", f"{root}/ck")

    def put(k, lsn, op="u", status="O"):
        image = "null" if op == "d" else '{"o_orderkey": %d, "o_orderstatus": "%s"}' % (k, status)
        return ('{"o_orderkey": %d}' % k, '{"after": %s, "op": "%s", "source": {"lsn": %d}}' % (image, op, lsn), lsn)

    def batch(*rows):
        return spark.createDataFrame(list(rows), "key string, value string, kafka_offset long")

    first = batch(put(1, 1), put(2, 2), put(3, 3, "x"))
    CS.apply_batch(first, 0, ORDER_ROW, ORDER_KEY, paths)
    second = batch(put(1, 10, "d"), put(2, 11, status="F"), (None, None, 12))
    for _ in range(2):                                   # a replayed batch changes nothing
        CS.apply_batch(second, 1, ORDER_ROW, ORDER_KEY, paths)
        rows = [(r.o_orderkey, r.o_orderstatus) for r in CS.current_rows(spark, ORDER_ROW, ORDER_KEY, paths).collect()]
        assert rows == [(2, "F")]
    CS.apply_batch(batch(put(1, 5), put(2, 4, status="P")), 2, ORDER_ROW, ORDER_KEY, paths)   # stale changes
    assert [(r.o_orderkey, r.o_orderstatus) for r in CS.current_rows(spark, ORDER_ROW, ORDER_KEY, paths).collect()] == [(2, "F")]
    assert [(r.kafka_offset, r.reason) for r in spark.read.parquet(paths.rejected).collect()] == [(3, "bad_op")]


def test_quarantine_retry_after_midnight_keeps_the_count(spark, scratch):
    from ledgerlake.operators import quarantine as QU
    q = spark.createDataFrame([(b"x", 0, 1), (b"y", 0, 2)], "raw_value binary, kafka_partition int, kafka_offset long")
    for day in ("2024-01-01", "2024-01-02"):
        QU.write_quarantine(q.withColumn("detected_date", F.lit(day).cast("date")), scratch, 7)
    QU.write_quarantine(q.withColumn("detected_date", F.lit("2024-01-02").cast("date")), scratch, 8)
    rows = spark.read.parquet(scratch)
    assert rows.count() == 4 and {str(r.detected_date) for r in rows.collect()} == {"2024-01-02"}
    assert len(QU.drop_expired_partitions(spark, scratch, "2024-06-01")) == 2
