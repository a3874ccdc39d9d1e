"""Q4 ledger, and the access paths of the scored table."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake.functions import wire
from ledgerlake.operators import forest as FO
from ledgerlake.operators import quarantine as QU
from ledgerlake.operators import signals as SG
from ledgerlake.plans.registry import REGISTRY_FIXED, REGISTRY_V1, silver_df
from ledgerlake.sources import files
from ledgerlake.sources.kafka import envelope_from_events
from ledgerlake.sources.tables import read_table


def quarantine(spark, scratch):
    env = envelope_from_events(read_table(spark, SF001, "events"))
    q = QU.quarantined(wire.decode(env, REGISTRY_V1))
    QU.write_quarantine(q, f"{scratch}/q", 0)
    QU.write_quarantine(q.limit(3), f"{scratch}/q", 1)                  # rejected twice
    return spark.read.parquet(f"{scratch}/q"), QU.ReplayPaths(f"{scratch}/accepted", f"{scratch}/emitted", f"{scratch}/ledger")


def key(r):
    return (r.kafka_partition, r.kafka_offset)


def test_attempts_are_idempotent_and_poison_rows_stop(spark, scratch):
    q, paths = quarantine(spark, scratch)
    messages = {key(r): r.reason for r in q.collect()}
    fixable = {k for k, r in messages.items() if r == "unknown_schema"}
    assert fixable and len(messages) < q.count()
    assert QU.replay_attempt(q, 1, paths, REGISTRY_V1, max_attempts=2)
    assert {r.state for r in QU.ledger_state(spark, paths.ledger).collect()} == {"failed"}
    assert QU.replay_attempt(q, 2, paths, REGISTRY_FIXED, max_attempts=2)
    before = sorted(map(tuple, QU.ledger_state(spark, paths.ledger).collect()), key=str)
    assert not QU.replay_attempt(q, 2, paths, REGISTRY_FIXED, max_attempts=2)          # the same attempt again
    assert QU.replay_attempt(q, 3, paths, REGISTRY_FIXED, max_attempts=2)              # a new one finds nothing open
    state = QU.ledger_state(spark, paths.ledger).collect()
    assert sorted(map(tuple, state), key=str) == before and len(state) == len(messages)
    assert {key(r) for r in state if r.state == "accepted"} == fixable
    assert all(r.state == "poison" and r.attempts == 2 and r.reason for r in state if key(r) not in fixable)
    accepted = QU.replayed(spark, paths.accepted, paths.ledger)
    assert sorted(key(r) for r in accepted.collect()) == sorted(fixable)
    emitted = QU.replayed(spark, paths.emitted, paths.ledger).collect()
    raw = {key(r): bytes(r.raw_value) for r in q.collect() if r.raw_value is not None}
    assert {key(r): bytes(r.value) for r in emitted} == {k: raw[k] for k in fixable} and {r.topic for r in emitted} == {QU.DEFAULT_TOPIC}
    assert {bytes(r.key).decode() for r in emitted} == {r.event_id for r in accepted.collect()}


def test_an_attempt_that_dies_before_its_ledger_is_open_still(spark, scratch, monkeypatch):
    q, paths = quarantine(spark, scratch)
    QU.replay_attempt(q, 1, paths, REGISTRY_FIXED)
    whole = sorted(key(r) for r in QU.replayed(spark, paths.accepted, paths.ledger).collect())
    files.delete(spark, f"{paths.ledger}/_attempt=1/_SUCCESS")                          # as if it had died while writing
    assert QU.attempts(spark, paths.ledger) == [] and QU.ledger_state(spark, paths.ledger).count() == 0
    QU.replay_attempt(q, 1, paths, REGISTRY_FIXED)
    assert sorted(key(r) for r in QU.replayed(spark, paths.accepted, paths.ledger).collect()) == whole
    assert {r.attempts for r in QU.ledger_state(spark, paths.ledger).collect()} == {1}


def test_a_fix_of_the_bytes_and_topics_of_their_own(spark, scratch):
    q, paths = quarantine(spark, scratch)
    two = q.withColumn("kafka_topic", F.lit("a")).unionByName(q.withColumn("kafka_topic", F.lit("b")))
    magic = lambda v: F.when(F.hex(F.substring(v, 1, 1)) == "01", F.concat(F.unhex(F.lit("00")), F.substring(v, 2, 1 << 30))).otherwise(v)
    QU.replay_attempt(two, 1, paths, REGISTRY_V1, fix=magic)
    state = QU.ledger_state(spark, paths.ledger).collect()
    want = {key(r) for r in q.filter("reason = 'bad_magic'").collect()}
    assert want and {(r.kafka_topic, *key(r)) for r in state if r.state == "accepted"} == {(t, *k) for t in "ab" for k in want}


@pytest.fixture(scope="module")
def signals(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("signals") / "scored")
    s = silver_df(spark, SF001)
    # more rows, one user with a third of them
    s = s.unionByName(s.withColumn("user_id", F.lit("USR_hot")).filter("event_hour < 12"))
    FO.write_signals(FO.score_silver(s, n_trees=10, sample_size=32, seed=1), path, files=16)
    return path


def scanned(df):
    """Rows that the scan handed on, after row groups were ruled out."""
    df.collect()
    plan, out = df._jdf.queryExecution().executedPlan(), []

    def walk(p):
        name = p.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(p.executedPlan())
        if name.startswith("Scan parquet"):
            out.append(p.metrics().apply("numOutputRows").value())
        kids = p.children()
        for i in range(kids.size()):
            walk(kids.apply(i))
    walk(plan)
    return sum(out)


def test_one_users_rows_lie_in_few_files(spark, signals):
    table = spark.read.parquet(signals)
    parts = sorted(glob.glob(f"{signals}/*.parquet"))
    assert len(parts) >= 8
    spans = [pq.ParquetFile(p).metadata.row_group(0).column(pq.ParquetFile(p).schema_arrow.get_field_index("user_id")).statistics for p in parts]
    users = [r.user_id for r in table.select("user_id").distinct().orderBy("user_id").collect()]
    quiet = [u for u in users if u != "USR_hot"][:40:8]
    for u in quiet:
        assert sum(s.min <= u <= s.max for s in spans) <= 2
        found = SG.for_user(table, u)
        assert scanned(found) <= table.count() / 4
        assert found.count() == table.filter(F.col("user_id") == u).count() > 0
    hot = sum(s.min <= "USR_hot" <= s.max for s in spans)
    assert hot >= 3                                            # a user with many rows is spread
    assert all(pq.ParquetFile(p).metadata.row_group(0).num_rows < table.count() / 4 for p in parts)
    # between two users' names no footer rules anything out, but the Bloom filters do
    assert SG.for_user(table, quiet[0] + "x").count() == 0 and scanned(SG.for_user(table, quiet[0] + "x")) == 0


def test_flagged_rows_stand_beside_the_table(spark, signals):
    table, side = spark.read.parquet(signals), spark.read.parquet(f"{signals}_anomalies")
    want = SG.anomalies(table)
    assert side.count() == want.count() > 0 and side.exceptAll(want).count() == 0
    assert sum(pq.ParquetFile(p).metadata.num_rows for p in glob.glob(f"{signals}_anomalies/*.parquet")) < table.count() / 10
