"""CDC invariants, velocity against brute force, access rules."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake.operators import access as AC
from ledgerlake.operators import cdc as CD
from ledgerlake.operators import signals as SG
from ledgerlake.operators import velocity as VE
from ledgerlake.plans.registry import silver_df
from ledgerlake.sources.changes import (ORDER_KEY, ORDER_ROW, PHASE_STRIDE,
                                        change_messages_from_orders)
from ledgerlake.sources.tables import read_table


def _valid(spark):
    msgs = change_messages_from_orders(read_table(spark, SF001, "orders"))
    return CD.valid_changes(CD.parse_changes(msgs, ORDER_ROW, ORDER_KEY))


def test_apply_is_idempotent_and_equals_state(spark):
    ch = _valid(spark)
    snap = CD.state_at(ch, ORDER_KEY, lsn=PHASE_STRIDE - 1, keep_lsn=True)
    once = CD.apply_changes(snap, CD.changes_since(ch, PHASE_STRIDE - 1), ORDER_KEY)
    twice = CD.apply_changes(once, CD.changes_since(ch, PHASE_STRIDE - 1), ORDER_KEY)
    final = CD.state_at(ch, ORDER_KEY, keep_lsn=True)
    for a, b in ((once, final), (twice, final)):
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merge_does_not_depend_on_the_join(spark):
    ch = _valid(spark)
    fields = ORDER_ROW.fieldNames()
    snap = CD.state_at(ch, ORDER_KEY, lsn=PHASE_STRIDE - 1, keep_lsn=True)
    odd = spark.createDataFrame([(None, None, "a", 1.0, None, None, 1), (None, None, "b", 2.0, None, None, 1)],
                                snap.select(*fields, "_lsn").schema)
    table = snap.select(*fields, "_lsn").unionByName(odd).checkpoint()
    later = CD.changes_since(ch, PHASE_STRIDE - 1)
    rows = []
    for limit in ("10485760", "-1"):
        old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        rows.append(sorted(map(tuple, CD.apply_changes(table, later, ORDER_KEY).collect()), key=str))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert rows[0] == rows[1] and all(r[0] is not None for r in rows[0])


def test_changes_that_cannot_be_applied(spark):
    good = '{"after": {"o_orderkey": 1, "o_orderstatus": "O"}, "op": "u", "source": {"lsn": 5}}'
    rows = [
        ('{"o_orderkey": 1}', good, None), ('{"o_orderkey": 1}', None, "tombstone"),
        ('{"o_orderkey": 2}', '{"after": null, "op": "u", "source": {"lsn": 6}}', "missing_after"),
        ('{"o_orderkey": 3}', '{"after": {"o_orderkey": 3}, "op": "c"}', "missing_lsn"),
        (None, '{"after": {"o_custkey": 3}, "op": "c", "source": {"lsn": 7}}', "missing_key"),
        ('{"o_orderkey": 1}', '{"op": "d", "before": null, "source": {"lsn": 4}}', None)]
    msgs = spark.createDataFrame([(k, v, i) for i, (k, v, _) in enumerate(rows)], "key string, value string, kafka_offset long")
    got = {r.seq: r._reason for r in CD.parse_changes(msgs, ORDER_ROW, ORDER_KEY).collect()}
    assert got == {i: why for i, (_, _, why) in enumerate(rows)}
    q = {r.kafka_offset: r.reason for r in CD.quarantined_changes(msgs, ORDER_ROW, ORDER_KEY).collect()}
    assert q == {i: why for i, (_, _, why) in enumerate(rows) if why not in (None, "tombstone")}
    state = CD.state_at(CD.valid_changes(CD.parse_changes(msgs, ORDER_ROW, ORDER_KEY)), ORDER_KEY).collect()
    assert [(r.o_orderkey, r.o_orderstatus) for r in state] == [(1, "O")]


def test_older_change_never_wins(spark):
    ch = _valid(spark)
    stale = ch.filter(F.col("lsn") < PHASE_STRIDE)       # snapshot rows only
    # with tombstones the table itself knows which keys were deleted
    final_t = CD.state_at(ch, ORDER_KEY, keep_lsn=True, keep_tombstones=True)
    again = CD.apply_changes(final_t, stale, ORDER_KEY, keep_tombstones=True)
    assert again.exceptAll(final_t).count() == 0 and final_t.exceptAll(again).count() == 0
    # without tombstones the caller's watermark protects deleted keys
    final = CD.state_at(ch, ORDER_KEY, keep_lsn=True)
    top = ch.agg(F.max("lsn")).first()[0]
    again2 = CD.apply_changes(final, stale, ORDER_KEY, applied_through=top)
    assert again2.exceptAll(final).count() == 0 and final.exceptAll(again2).count() == 0
    # and an update older than the row in the table loses
    upd = CD.apply_changes(final_t, ch.filter("op = 'u'"), ORDER_KEY, keep_tombstones=True)
    assert upd.exceptAll(final_t).count() == 0


def test_delete_without_before_uses_message_key(spark):
    msgs = spark.createDataFrame([
        ('{"o_orderkey": 7}', '{"before": null, "after": {"o_orderkey": 7, "o_custkey": 1, "o_orderstatus": "O", '
         '"o_totalprice": 1.5, "o_orderdate": "2024-01-01", "o_orderpriority": "1-URGENT"}, "op": "c", '
         '"source": {"lsn": 10}}', 1),
        ('{"o_orderkey": 7}', '{"before": null, "after": null, "op": "d", "source": {"lsn": 11}}', 0),
        ('{"o_orderkey": 8}', '{"after": {"o_orderkey": 8}, "op": "z", "source": {"lsn": 12}}', 2),
        ('{"o_orderkey": 9}', 'not json', 3),
    ], "key string, value string, kafka_offset long")
    parsed = CD.parse_changes(msgs, ORDER_ROW, ORDER_KEY)
    reasons = {r.o_orderkey: r._reason for r in parsed.collect()}
    assert reasons[8] == "bad_op" and reasons[9] == "bad_json"
    state = CD.state_at(CD.valid_changes(parsed), ORDER_KEY)
    assert state.count() == 0
    q = CD.quarantined_changes(msgs, ORDER_ROW, ORDER_KEY).orderBy("kafka_offset").collect()
    assert [(r.kafka_offset, r.reason) for r in q] == [(2, "bad_op"), (3, "bad_json")]
    assert bytes(q[1].raw_value) == b"not json"


def test_lsn_tie_breaks_on_arrival(spark):
    rows = [('{"o_orderkey": 1}', '{"after": {"o_orderkey": 1, "o_orderstatus": "%s"}, "op": "u", '
             '"source": {"lsn": 5}}' % s, off) for s, off in (("A", 1), ("B", 2))]
    msgs = spark.createDataFrame(rows, "key string, value string, kafka_offset long")
    st = CD.state_at(CD.valid_changes(CD.parse_changes(msgs, ORDER_ROW, ORDER_KEY)), ORDER_KEY).first()
    assert st.o_orderstatus == "B"


def test_audit_values(spark):
    ch = _valid(spark)
    a = CD.audit(ch, ORDER_KEY).filter("o_orderkey = 5 AND op = 'u'").first()
    assert a.column_name == "o_orderstatus" and a.old_value != a.new_value


def test_latest_per_key_is_partial_aggregate(spark):
    plan = CD.state_at(_valid(spark), ORDER_KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def _brute_velocity(rows, minutes):
    out = {}
    w = dt.timedelta(minutes=minutes)
    for i, (eid, user, ts, amt) in enumerate(rows):
        same = [r for r in rows if r[1] == user and ts - w <= r[2] <= ts]
        amts = [r[3] for r in same if r[3] is not None]
        out[eid] = (len(same), round(sum(amts), 2) if amts else None)
    return out


def test_velocity_matches_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        user = "hot" if i % 3 == 0 else f"u{rnd.randint(0, 20)}"  # one user holds a third
        ts = base + dt.timedelta(seconds=rnd.randint(0, 3 * 3600))
        amt = None if i % 17 == 0 else float(rnd.randint(1, 5000)) / 100
        rows.append((f"e{i}", user, ts, amt))
    df = spark.createDataFrame(rows, "event_id string, user_id string, event_timestamp timestamp, amount double")
    want = _brute_velocity(rows, 10)
    for split in (1, 4):
        got = {r.event_id: (r.velocity_count, r.velocity_amount)
               for r in VE.velocity(df, minutes=10, threshold=3, split=split).collect()}
        assert got.keys() == want.keys()
        for k in want:
            assert got[k][0] == want[k][0], (split, k)
            assert (got[k][1] is None and want[k][1] is None) or abs(got[k][1] - want[k][1]) < 1e-6


def test_velocity_partitions_by_user_and_bucket(spark):
    df = read_table(spark, SF001, "events").selectExpr(
        "CAST(user_id AS STRING) AS user_id", "CAST(ts AS TIMESTAMP) AS event_timestamp", "value AS amount")
    plan = VE.velocity(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_u") == 1      # one shuffle, by (user, bucket)
    assert "hashpartitioning(_u#" in plan and ", _b#" in plan
    frames = plan.split("specifiedwindowframe(")[1:]
    assert frames and all(f.split(",")[1].strip().startswith("unboundedpreceding") for f in frames)


def test_roles(spark):
    s = silver_df(spark, SF001)
    assert "ip_address" not in AC.role_view(s, "gold", "data-analysts").columns
    assert "ip_address" in AC.role_view(s, "silver", "data-engineers").columns
    with pytest.raises(PermissionError):
        AC.role_view(s, "gold", "ml-engineers")
    with pytest.raises(PermissionError):
        AC.role_view(s, "silver", "interns")


def test_mask_and_strip(spark):
    df = spark.createDataFrame([("10.0.7.42", True), ("2001:db8::1", False), (None, None)],
                               "ip_address string, _is_fraud_label boolean")
    out = [r.ip_address for r in AC.strip_label(AC.mask_ip(df)).collect()]
    assert out == ["10.0.7.0", "2001:db8::1", None]
    assert AC.strip_label(df).columns == ["ip_address"]


def test_recent_is_top_k(spark):
    s = silver_df(spark, SF001)
    top = SG.recent(s, 5)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    got = [r.event_timestamp for r in top.collect()]
    assert got == sorted(got, reverse=True)


def test_velocity_keeps_odd_amounts_to_their_frames(spark):
    import datetime as dt
    import math

    from ledgerlake.operators.velocity import velocity
    day = dt.datetime(2024, 1, 1)

    def at(m):
        return day + dt.timedelta(minutes=m)

    for odd in (float("nan"), float("inf"), 1e17):
        rows = [("u", at(1), odd), ("u", at(15), 5.0), ("u", at(19), 7.0), ("u", at(20), None), ("v", at(15), 1.0)]
        rows += [(None, at(2), 1.0), ("u", None, odd), (None, None, 2.0)]
        df = spark.createDataFrame(rows, "user_id string, event_timestamp timestamp, amount double")
        for split in (1, 5):
            out = velocity(df, 10, 1, split=split).collect()
            got = {(r.user_id, r.event_timestamp): r for r in out}
            assert len(out) == len(rows)
            assert [got["u", at(m)].velocity_amount for m in (15, 19, 20)] == [5.0, 12.0, 12.0]
            assert [got["u", at(m)].velocity_count for m in (1, 15, 19, 20)] == [1, 1, 2, 3]
            first = got["u", at(1)].velocity_amount
            assert math.isnan(first) if math.isnan(odd) else first == odd
            assert [got["u", at(m)].velocity_alert for m in (15, 19)] == [False, True]
            assert all(r.velocity_count is None and r.velocity_amount is None and r.velocity_alert is None
                       for (u, t), r in got.items() if u is None or t is None)
