"""Steps whose share of one task must not grow with the table: landing files, buckets,
windows, states; and what replaced the steps that did."""

import datetime as dt
import random

from pyspark.sql import functions as F

import test_stateful_streams as ST
from conftest import SF001
from ledgerlake.functions import avro, wire
from ledgerlake.operators import cdc
from ledgerlake.operators import velocity as VE
from ledgerlake.plans import registry as RE
from ledgerlake.sources import files
from ledgerlake.sources.changes import ORDER_KEY, ORDER_ROW
from ledgerlake.streaming import velocity_state as VS


def _landed(spark, path):
    return len([n for n in files.list_names(spark, path) if n.endswith(".parquet")])


def test_landed_files_follow_the_bytes_that_are_landed(spark, scratch, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    assert RE.land_envelopes(spark, SF001, f"{scratch}/few/landing", None) == max(cores, RE.STREAM_FILES)
    RE._land_changes(spark, SF001, f"{scratch}/fewer")
    staged = files.folder_bytes(spark, f"{scratch}/fewer/staged")
    monkeypatch.setattr(RE, "LANDED_BYTES", staged // (3 * cores))
    RE._land_changes(spark, SF001, f"{scratch}/changes")
    assert _landed(spark, f"{scratch}/changes/landing") >= 2 * cores > _landed(spark, f"{scratch}/fewer/landing")
    slices = RE.land_envelopes(spark, SF001, f"{scratch}/many/landing", None)
    assert slices > cores and _landed(spark, f"{scratch}/many/landing") <= slices
    a, b = (spark.read.parquet(f"{scratch}/{x}/landing") for x in ("few", "many"))
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


def test_buckets_and_windows_follow_the_table(spark, monkeypatch):
    least = RE._table_buckets(spark, SF001), RE._window_parts(spark, SF001)
    monkeypatch.setattr(RE, "TABLE_BYTES", 500)
    monkeypatch.setattr(RE, "WINDOW_BYTES", 500)
    assert RE._table_buckets(spark, SF001) > least[0] and RE._window_parts(spark, SF001) > least[1]


def test_velocity_in_more_partitions(spark):
    tx = RE._tx(spark, SF001)
    for split in (1, 5):
        plain, dealt = (VE.velocity(tx, 1440, 3, split=split, partitions=p) for p in (None, 37))
        assert plain.exceptAll(dealt).count() == 0 == dealt.exceptAll(plain).count()
        assert dealt.rdd.getNumPartitions() >= 37


def test_one_join_merges_as_apply_changes_does(spark):
    r = random.Random(4)

    def image(k):
        return (k, r.randrange(5), r.choice(["O", "F", None]), r.choice([1.5, None]), dt.date(2024, 1, r.randrange(1, 9)), "p")

    table = [(*image(k), r.choice([None, 3, 5]), k % 4 == 0) for k in range(60)]
    row = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ORDER_ROW.fields)
    held = spark.createDataFrame(table, f"{row}, _lsn long, _deleted boolean")
    changes = [(k, op, None, None if op == "d" else image(k), r.choice([3, 5, 9]), None, None, r.choice([-9, -1, 4]))
               for k in range(20, 90) for op in r.choices("cud", k=1 + k % 3)]
    ch = spark.createDataFrame(changes, f"o_orderkey long, op string, before struct<{row.replace(' ', ':').replace(',:', ',')}>, "
                                        f"after struct<{row.replace(' ', ':').replace(',:', ',')}>, lsn long, tx_id long, table string, seq long")
    got = cdc.merge_latest(held, cdc.latest_per_key(ch, ORDER_KEY), ORDER_KEY)
    want = cdc.apply_changes(held, ch, ORDER_KEY, keep_tombstones=True).select(*got.columns)
    live = [f.name for f in ORDER_ROW.fields] + ["_lsn", "_deleted"]
    # a tombstone's other columns mean nothing: an untouched one keeps them in apply_changes
    plain = lambda df: sorted(str(tuple(x)) for x in df.select(*[F.when(~F.col("_deleted") | F.lit(c in (*ORDER_KEY, "_lsn", "_deleted")), F.col(c)).alias(c) for c in live]).collect())
    assert plain(got) == plain(want)


def test_columns_encode_as_records_do(spark):
    fields = avro.parse_schema(wire.TRANSACTION_SCHEMA_JSON)
    values = {"string": ["", "x", "é" * 31, "é" * 32, "y" * 200, None], "double": [0.0, -0.0, 1.5, float("inf"), None], "boolean": [True, False, None]}
    for name, branches, _ in fields:
        own = values[next(b for b in branches if b != "null")]
        for v, got in zip(own, avro.encode_values(name, branches, own), strict=True):
            try:
                want = avro.encode_record([(name, branches, None)], {name: v})
            except avro.AvroError:
                want = None
            assert got == want, (name, v)
    tx = RE._tx(spark, SF001).withColumn("user_id", F.when(F.col("event_id").endswith("7"), None).otherwise(F.col("user_id")))
    made = wire.encode(tx, keep=["event_id", "user_id"])
    back = wire.accepted(wire.decode(made.select("event_id", F.col("value").alias("raw_bytes")), RE.REGISTRY_V1))
    assert made.filter("value IS NULL").count() == tx.filter("event_id IS NULL OR user_id IS NULL").count() > 0
    assert back.count() == made.filter("value IS NOT NULL").count()


def test_states_are_as_many_as_buckets_not_users(spark, monkeypatch):
    monkeypatch.setattr(VS, "USER_BUCKETS", 4)
    root, _ = RE.stream_paths(spark, "t-buckets")
    r = random.Random(2)
    rows = [(f"e{i}", f"u{r.randrange(50)}", ST.DAY + dt.timedelta(seconds=i * 5), r.choice([None, 1.25, 7.5]), i) for i in range(300)]
    ST.land(spark, root, [rows[:150], rows[150:], [("end", "end", ST.DAY + dt.timedelta(days=9), 0.0, 10_000)]])
    q = ST.run(spark, root, ST.TX, minutes=10, threshold=3, watermark="1 minute")
    stats = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]]
    assert max(stats) <= 4 and stats[-1] == 1
    want = VE.velocity(spark.createDataFrame(rows, ST.TX), minutes=10, threshold=3)
    assert ST.keyed(spark.read.parquet(f"{root}/out")) == ST.keyed(want)
