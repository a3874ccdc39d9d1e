"""Bucketed keyed table and LSN-pruned change log."""

import random

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import cdc as CD
from ledgerlake.plans import registry as RE
from ledgerlake.sources import files
from ledgerlake.sources.changes import ORDER_KEY, ORDER_ROW
from ledgerlake.streaming import change_log as CL
from ledgerlake.streaming import changes as CS
from ledgerlake.streaming import keyed_table as KT
from ledgerlake.streaming.keyed_table import KeyedTable


def changes(spark, rows):
    """(key, lsn, op, status) as valid parsed changes."""
    kind = CS.log_schema(ORDER_ROW, ORDER_KEY)
    out = []
    for n, (k, lsn, op, status) in enumerate(rows):
        image = None if op == "d" else (k, 1, status, 1.5, None, "x")
        out.append((k, op, None, image, lsn, None, "orders", n))
    return spark.createDataFrame(out, kind)


def state(rows):
    last = {}
    for n, (k, lsn, op, status) in enumerate(rows):
        if k is not None and ((lsn, n) >= last.get(k, ((-1, -1),))[0]):
            last[k] = ((lsn, n), op, status)
    return sorted((k, s) for k, (_, op, s) in last.items() if op != "d")


def read(table, spark, **kw):
    return sorted((r.o_orderkey, r.o_orderstatus) for r in table.rows(spark, **kw).collect())


def test_only_touched_buckets_are_rewritten(spark, scratch):
    table = KeyedTable(f"{scratch}/t", ORDER_ROW, tuple(ORDER_KEY), 16)
    base = [(k, k, "r", "O") for k in range(4000)]
    first = table.merge(spark, changes(spark, base), 0)
    assert first["touched"] == 16 and read(table, spark) == state(base)
    one = table.merge(spark, changes(spark, [(7, 9000, "u", "P")]), 1)
    few = table.merge(spark, changes(spark, [(k, 9001 + k, "u", "Q") for k in range(6)]), 2)
    assert one["touched"] == 1 and one["bytes"] < first["bytes"] / 8
    assert 1 < few["touched"] <= 6 and one["bytes"] < few["bytes"] < first["bytes"] / 2
    assert sum(v == 0 for v in few["buckets"].values()) >= 16 - 7
    want = state(base + [(7, 9000, "u", "P")] + [(k, 9001 + k, "u", "Q") for k in range(6)])
    assert read(table, spark) == want and read(table, spark, version=0) == state(base)
    assert read(table, spark, keys=[(7,), (3,), (99999,)]) == [(3, "Q"), (7, "P")]
    # nothing at all, then only rows without a key
    none = table.merge(spark, changes(spark, []), 3)
    assert none["touched"] == 0 and none["bytes"] == 0
    assert table.merge(spark, changes(spark, [(None, 5, "u", "P")]), 4)["touched"] == 0 and read(table, spark) == want


def test_random_batches_equal_a_plain_replay(spark, scratch):
    r = random.Random(3)
    table, done = KeyedTable(f"{scratch}/t", ORDER_ROW, tuple(ORDER_KEY), 4), []
    for version in range(6):
        batch = [(r.randrange(30), r.randrange(500), r.choice("cuuud"), r.choice("OPF")) for _ in range(r.randrange(1, 60))]
        # one key with a third of a batch
        batch += [(1, r.randrange(500), "u", r.choice("OPF")) for _ in range(len(batch) // 2)]
        batch = [(k, lsn * 100 + version * 10 + i % 10, op, s) for i, (k, lsn, op, s) in enumerate(batch)]
        batch = list({(b[0], b[1]): b for b in batch}.values())
        batch = [b for b in batch if (b[0], b[1]) not in {(d[0], d[1]) for d in done}]
        table.merge(spark, changes(spark, batch), version)
        done += batch
        assert read(table, spark) == state(done)


def test_a_crash_between_buckets_and_retries_give_equal_state(spark, scratch, monkeypatch):
    table = KeyedTable(f"{scratch}/t", ORDER_ROW, tuple(ORDER_KEY), 8)
    base = [(k, k, "r", "O") for k in range(200)]
    table.merge(spark, changes(spark, base), 0)
    update = [(k, 1000 + k, "u" if k % 3 else "d", "P") for k in range(0, 200, 2)]

    def crash(*a):
        raise RuntimeError("lost the driver before the manifest")
    with monkeypatch.context() as m:
        m.setattr(KT.files, "write_json", crash)
        with pytest.raises(RuntimeError):
            table.merge(spark, changes(spark, update), 1)
    # the write is half there: some buckets of version 1, and one of them lost
    folder = f"{scratch}/t/data/version=1"
    files.delete(spark, f"{folder}/{[n for n in files.list_names(spark, folder) if n.startswith('bucket')][0]}")
    assert table.versions(spark) == [0] and read(table, spark) == state(base)
    for _ in range(2):
        now = table.merge(spark, changes(spark, update), 1)
        assert read(table, spark) == state(base + update) and now["version"] == 1
    # a late retry of an older batch changes nothing either
    table.merge(spark, changes(spark, [(1, 5000, "u", "F")]), 2)
    table.merge(spark, changes(spark, update), 1)
    assert (1, "F") in read(table, spark)


def test_vacuum_keeps_what_the_last_versions_hold(spark, scratch):
    table = KeyedTable(f"{scratch}/t", ORDER_ROW, tuple(ORDER_KEY), 8)
    done = [(k, k, "r", "O") for k in range(100)]
    table.merge(spark, changes(spark, done), 0)
    for v in range(1, 5):
        batch = [(k, 1000 * v + k, "u", str(v)) for k in range(v)]
        table.merge(spark, changes(spark, batch), v)
        done += batch
    assert table.vacuum(spark, keep=2) > 0 and table.versions(spark) == [3, 4]
    assert read(table, spark) == state(done) and len(read(table, spark, version=3)) == 100
    live = {(b, v) for n in (3, 4) for b, v in table.manifest(spark, n)["buckets"].items()}
    there = {(n.split("=")[1], int(v.split("=")[1])) for v in files.list_names(spark, f"{scratch}/t/data")
             for n in files.list_names(spark, f"{scratch}/t/data/{v}") if n.startswith("bucket=")}
    assert there == live and table.vacuum(spark, keep=2) == 0


def test_log_is_cut_by_lsn_and_replays_read_overlapping_files_only(spark, scratch):
    rows = [(k, k, "u", "O") for k in range(3000)]
    random.Random(1).shuffle(rows)
    CL.append(changes(spark, rows), scratch, 0, file_rows=300)
    CL.append(changes(spark, [(k, 5000 + k, "u", "P") for k in range(10)]), scratch, 1)
    CL.append(changes(spark, [(k, 5000 + k, "u", "P") for k in range(10)]), scratch, 1)      # retried
    spans = CL.manifest(spark, scratch).collect()
    assert sum(s.rows for s in spans) == 3010 and sum(s.batch_id == 0 for s in spans) >= 8
    schema = CS.log_schema(ORDER_ROW, ORDER_KEY)
    assert CL.changes_since(spark, scratch, schema, -1).count() == 3010
    tail = CL.changes_since(spark, scratch, schema, 2800)
    assert sorted(r.lsn for r in tail.select("lsn").collect()) == [*range(2801, 3000), *range(5000, 5010)]
    assert len(tail.inputFiles()) < len(spans) / 2
    mid = CL.changes_since(spark, scratch, schema, 999, 1200)
    assert sorted(r.lsn for r in mid.select("lsn").collect()) == list(range(1000, 1201)) and len(mid.inputFiles()) <= 3
    assert CL.changes_since(spark, scratch, schema, 10 ** 9).count() == 0
    assert CL.changes_since(spark, scratch, schema, 10 ** 9).schema == schema


def test_message_batch_is_parsed_once_and_goes_three_ways(spark, scratch):
    paths = CS.ChangePaths(f"{scratch}/log", f"{scratch}/rejected", f"{scratch}/table", f"{scratch}/ck", 4)
    rows = [('{"o_orderkey": 1}', '{"after": {"o_orderkey": 1, "o_orderstatus": "A"}, "op": "c", "source": {"lsn": 5}}', 1),
            ('{"o_orderkey": 2}', "broken", 2), (None, None, 3)]
    CS.apply_batch(spark.createDataFrame(rows, "key string, value string, kafka_offset long"), 0, ORDER_ROW, ORDER_KEY, paths)
    assert [(r.kafka_offset, r.reason, bytes(r.raw_value)) for r in spark.read.parquet(paths.rejected).collect()] == [(2, "bad_json", b"broken")]
    log = CL.changes_since(spark, paths.log, CS.log_schema(ORDER_ROW, ORDER_KEY), -1)
    assert [(r.o_orderkey, r.lsn) for r in log.collect()] == [(1, 5)]
    assert [r.o_orderstatus for r in CS.current_rows(spark, ORDER_ROW, ORDER_KEY, paths).collect()] == ["A"]
    assert CD.state_at(log, ORDER_KEY).select(F.count(F.lit(1))).first()[0] == 1


def _row_groups(spark, path):
    return [pq.ParquetFile(f"{path}/{n}".removeprefix("file:")).num_row_groups for n in files.list_names(spark, path) if n.endswith(".parquet")]


def test_a_batch_takes_no_memory_between_its_steps(spark, scratch, monkeypatch):
    paths = CS.ChangePaths(f"{scratch}/log", f"{scratch}/rejected", f"{scratch}/table", f"{scratch}/ck", 4)
    monkeypatch.setattr(files, "ROW_GROUPS", {"parquet.block.size": "10000"}, raising=False)
    seen, merge = [], KeyedTable.merge

    def cached():
        return set(spark.sparkContext._jsc.getPersistentRDDs().keySet())

    before = cached()

    def watched(self, session, log, version):
        # a cached batch would be here, in blocks as large as the files of its input
        assert cached() <= before
        seen.append(_row_groups(session, f"{paths.log}/parsed/_batch_id={version}"))
        kept = session.read.parquet(f"{paths.log}/parsed/_batch_id={version}")
        assert kept.filter("raw_value IS NOT NULL").count() == kept.filter("_reason IS NOT NULL").count() == 3
        return merge(self, session, log, version)

    monkeypatch.setattr(KeyedTable, "merge", watched)
    text = F.format_string('{"after": {"o_orderkey": %d, "o_orderstatus": "%s"}, "op": "c", "source": {"lsn": 5}}', "id", F.sha2(F.col("id").cast("string"), 512))
    messages = spark.range(0, 4000, 1, 2).select(F.lit(None).cast("string").alias("key"), F.when(F.col("id") % 1500 == 7, "broken").otherwise(text).alias("value"),
                                                 F.col("id").alias("kafka_offset"))
    for batch in (0, 0, 1):                              # the first one retried
        CS.apply_batch(messages, batch, ORDER_ROW, ORDER_KEY, paths)
    assert len(seen) == 3 and all(min(groups) > 1 for groups in seen)
    assert not files.list_names(spark, f"{paths.log}/parsed") and min(_row_groups(spark, f"{paths.log}/data/_batch_id=0")) > 1
    assert CS.current_rows(spark, ORDER_ROW, ORDER_KEY, paths).count() == 3997
    assert CL.changes_since(spark, paths.log, CS.log_schema(ORDER_ROW, ORDER_KEY), -1).count() == 2 * 3997
    assert sorted(bytes(r.raw_value) for r in spark.read.parquet(paths.rejected).collect()) == [b"broken"] * 6


def test_landed_changes_have_small_row_groups(spark, scratch, monkeypatch):
    monkeypatch.setattr(RE, "ROW_GROUPS", {"parquet.block.size": "10000"}, raising=False)
    rows = spark.range(1, 6001, 1, 2).selectExpr("id o_orderkey", "id o_custkey", "'O' o_orderstatus", "id / 7.0D o_totalprice",
                                                 "TIMESTAMP'2024-01-01' o_orderdate", "sha2(string(id), 256) o_orderpriority")
    rows.write.parquet(f"{scratch}/in/orders.parquet")
    landed = RE._land_changes(spark, f"{scratch}/in", f"{scratch}/out")
    assert landed.isStreaming
    assert min(_row_groups(spark, f"{scratch}/out/staged")) > 1 < min(_row_groups(spark, f"{scratch}/out/landing"))
