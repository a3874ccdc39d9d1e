"""X5 and X6 with keyed state: exact, bounded, and late rows counted."""

import datetime as dt
import random

from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake.functions import wire
from ledgerlake.operators import velocity as VE
from ledgerlake.plans.registry import REGISTRY_V1, stream_paths
from ledgerlake.schemas import ENVELOPE_SCHEMA
from ledgerlake.sources import files
from ledgerlake.sources.kafka import envelope_from_events
from ledgerlake.sources.tables import read_table
from ledgerlake.streaming import jobs as JB
from ledgerlake.streaming import velocity_state as VS

DAY = dt.datetime(2024, 1, 1)
TX = "event_id string, user_id string, event_timestamp timestamp, amount double, n int"


def run(spark, root, schema, **kw):
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    q = (VS.velocity_exact(source, **kw).writeStream.outputMode("append").format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/_ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    return q


def land(spark, root, batches, schema=TX):
    """One file a batch, in this order."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")
    names = [n for n in files.list_names(spark, f"{root}/in") if n.endswith(".parquet")]
    order = sorted(names, key=lambda n: spark.read.parquet(f"{root}/in/{n}").agg(F.min("n")).first()[0])
    for k, n in enumerate(order):
        files.set_modified(spark, f"{root}/in/{n}", 1_700_000_000_000 + k * 1000)


def keyed(df):
    return sorted(((r.event_id, r.user_id, r.velocity_count, r.velocity_amount, r.velocity_alert) for r in df.collect()), key=str)


def test_stream_equals_batch_row_by_row(spark):
    """Out of order inside the watermark, one user with a third of the rows, peers,
    null, NaN-free and null amounts, rows without user or time."""
    r = random.Random(8)
    root, _ = stream_paths(spark, "t-exact")
    rows = []
    for i in range(400):
        user = "hot" if i % 3 == 0 else f"u{r.randrange(12)}"
        at = DAY + dt.timedelta(seconds=i * 20 + r.randrange(-240, 240) // 10 * 10)
        rows.append((f"e{i}", user if i % 50 else None, at if i % 61 else None, None if i % 17 == 0 else r.randrange(1, 9000) / 100, i))
    batches = [rows[i:i + 100] for i in range(0, 400, 100)]
    end = [("end", "end", DAY + dt.timedelta(days=9), 0.0, 10_000)]
    land(spark, root, [*batches, end])
    q = run(spark, root, TX, minutes=10, threshold=3, watermark="10 minutes")
    got, want = spark.read.parquet(f"{root}/out"), VE.velocity(spark.createDataFrame(rows, TX), minutes=10, threshold=3)
    assert got.columns == want.columns and keyed(got) == keyed(want)
    stats = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in stats) == 0
    assert stats[-1]["numRowsTotal"] == 1                      # only the row that ended the input


def test_odd_amounts_keep_to_their_frames(spark):
    root, _ = stream_paths(spark, "t-odd")
    at = lambda m: DAY + dt.timedelta(minutes=m)
    rows = [("a", "u", at(1), float("nan"), 1), ("b", "u", at(5), 2.0, 2), ("c", "u", at(15), 5.0, 3), ("d", "u", at(15), None, 4),
            ("e", "u", at(19), float("inf"), 5), ("f", "v", at(19), 1.005, 6), ("g", "u", at(40), 3.0, 7)]
    land(spark, root, [rows[:2], rows[2:], [("end", "end", at(9999), 0.0, 10_000)]])
    run(spark, root, TX, minutes=10, threshold=1, watermark="1 minute")
    got = {x.event_id: x for x in spark.read.parquet(f"{root}/out").collect()}
    want = {x.event_id: x for x in VE.velocity(spark.createDataFrame(rows, TX), minutes=10, threshold=1).collect()}
    assert got.keys() == want.keys()
    for k in want:
        assert str(tuple(got[k])) == str(tuple(want[k])), k


def test_late_rows_are_counted_and_state_is_dropped(spark):
    root, _ = stream_paths(spark, "t-late")
    at = lambda m: DAY + dt.timedelta(minutes=m)
    many = [(f"m{i}", f"u{i % 40}", at(i % 9), 1.0, 1 + i) for i in range(200)]
    later = [(f"l{i}", "w", at(300 + i), 1.0, 1000 + i) for i in range(3)]
    late = [("late", "u1", at(2), 1.0, 2000), ("x", "w", at(320), 1.0, 2001)]
    land(spark, root, [many, later, late, [("end", "end", at(9999), 0.0, 10_000)]])
    q = run(spark, root, TX, minutes=10, threshold=3, watermark="5 minutes")
    stats = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in stats) == 1
    assert max(s["numRowsTotal"] for s in stats) >= 40 and stats[-1]["numRowsTotal"] == 1
    got = spark.read.parquet(f"{root}/out")
    assert got.count() == 204 and got.filter("event_id = 'late'").count() == 0


def test_restart_goes_on_from_the_state(spark):
    root, _ = stream_paths(spark, "t-resume")
    at = lambda m: DAY + dt.timedelta(minutes=m)
    first = [(f"a{i}", "u", at(i), 1.0, i) for i in range(6)]
    land(spark, root, [first])
    run(spark, root, TX, minutes=10, threshold=3, watermark="2 minutes")
    second = [(f"b{i}", "u", at(6 + i), 2.0, 100 + i) for i in range(6)]
    spark.createDataFrame(second, TX).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run(spark, root, TX, minutes=10, threshold=3, watermark="2 minutes")
    spark.createDataFrame([("end", "end", at(9999), 0.0, 10_000)], TX).coalesce(1).write.mode("append").parquet(f"{root}/in")
    run(spark, root, TX, minutes=10, threshold=3, watermark="2 minutes")
    want = VE.velocity(spark.createDataFrame(first + second, TX), minutes=10, threshold=3)
    assert keyed(spark.read.parquet(f"{root}/out")) == keyed(want)


# ---- X5 -----------------------------------------------------------------------

def _deduped(spark, landing, paths, within, files_a_batch=1):
    source = (spark.readStream.schema(ENVELOPE_SCHEMA).option("recursiveFileLookup", "true")
              .option("maxFilesPerTrigger", files_a_batch).parquet(landing))
    q = JB.start_stream(source, REGISTRY_V1, paths, trigger={"availableNow": True}, dedupe_within=within)
    q.awaitTermination()
    assert q.exception() is None
    return q


def test_redeliveries_are_dropped_and_nothing_else(spark):
    root, paths = stream_paths(spark, "t-within")
    landing = f"{root}/landing"
    env = envelope_from_events(read_table(spark, SF001, "events"))                 # with defective messages
    late_cut = "2024-01-20"
    env.filter(f"kafka_timestamp >= '{late_cut}'").coalesce(1).write.parquet(f"{landing}/a")
    env.filter(f"kafka_timestamp < '{late_cut}'").coalesce(1).write.parquet(f"{landing}/b")      # the older half, late
    env.filter("kafka_partition = 0").coalesce(1).write.parquet(f"{landing}/c")                  # delivered again
    q = _deduped(spark, landing, paths, "2 days")
    want = wire.decode(env, REGISTRY_V1)
    silver, bad = spark.read.parquet(paths.silver), spark.read.parquet(paths.quarantine)
    good = wire.accepted(want)
    assert silver.count() == good.count() and silver.select("event_id").exceptAll(good.select("event_id")).count() == 0
    assert bad.count() == want.filter("_reason IS NOT NULL").count()
    state = [p["stateOperators"][0] for p in q.recentProgress if p["stateOperators"]]
    assert sum(s["numRowsDroppedByWatermark"] for s in state) == 0


def test_state_is_bounded_by_the_horizon(spark):
    """With the arrival time as the clock, keys older than the horizon leave."""
    root, _ = stream_paths(spark, "t-bounded")
    kind = "_reason string, event_id string, kafka_partition int, kafka_offset long, arrived timestamp, n int"
    hours = lambda h: DAY + dt.timedelta(hours=h)
    batches = [[(None, f"id{h}-{i}", 0, h * 100 + i, hours(h), h * 100 + i) for i in range(20)] for h in range(0, 40, 4)]
    batches[3] += [(None, "id8-1", 1, 1, hours(12), 1299)]                 # within 6 hours: dropped
    batches[9] += [(None, "id0-1", 1, 2, hours(36), 3699)]                 # beyond the horizon: a new delivery
    batches[9] += [("bad", "id36-1", 1, 3, hours(36), 3700)] * 1
    land(spark, root, batches, kind)
    source = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    q = (JB.first_deliveries(source, "6 hours", clock="arrived").writeStream.format("parquet").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/_ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert q.exception() is None
    out = [(r.event_id, r.kafka_partition) for r in spark.read.parquet(f"{root}/out").collect()]
    assert ("id8-1", 1) not in out and ("id0-1", 1) in out and ("id36-1", 1) in out and len(out) == 202
    rows = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(rows) <= 4 * 20 + 2                                         # of 203 keys
