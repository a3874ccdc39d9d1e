"""Wire codec: round trip, every quarantine reason, property test, replay."""

import json
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF001
from ledgerlake.functions import avro, resolve, wire
from ledgerlake.operators import quarantine as QU
from ledgerlake.plans.registry import REGISTRY_FIXED, REGISTRY_V1
from ledgerlake.sources.kafka import envelope_from_events
from ledgerlake.sources.tables import read_table

FIELDS = avro.parse_schema(wire.TRANSACTION_SCHEMA_JSON)
COMPILED = avro.compile_decoder(FIELDS)

opt_text = st.one_of(st.none(), st.text(max_size=40))


@settings(max_examples=200, deadline=None)
@given(event_id=st.text(max_size=40), ts=st.text(max_size=30), user=st.text(max_size=20),
       cat=opt_text, amount=st.one_of(st.none(), st.floats(allow_nan=False)),
       online=st.one_of(st.none(), st.booleans()), ip=opt_text)
def test_codec_round_trip_property(event_id, ts, user, cat, amount, online, ip):
    rec = {"event_id": event_id, "event_timestamp": ts, "user_id": user,
           "merchant_category": cat, "amount": amount, "is_online": online, "ip_address": ip}
    body = avro.encode_record(FIELDS, rec)
    back = avro.decode_record(FIELDS, body)
    for k, v in rec.items():
        assert back[k] == v
    assert back["terminal_id"] is None
    fast = COMPILED(memoryview(body))
    assert fast == [back[n] for n, _, _ in FIELDS]


def test_codec_nan_and_infinity():
    for v in (float("inf"), float("-inf")):
        back = avro.decode_record(FIELDS, avro.encode_record(
            FIELDS, {"event_id": "a", "event_timestamp": "t", "user_id": "u", "amount": v}))
        assert back["amount"] == v
    back = avro.decode_record(FIELDS, avro.encode_record(
        FIELDS, {"event_id": "a", "event_timestamp": "t", "user_id": "u", "amount": float("nan")}))
    assert back["amount"] != back["amount"]


def test_required_null_cannot_be_encoded():
    with pytest.raises(avro.AvroError):
        avro.encode_record(FIELDS, {"event_id": None, "event_timestamp": "t", "user_id": "u"})


def test_truncated_body_raises():
    body = avro.encode_record(FIELDS, {"event_id": "abc", "event_timestamp": "t", "user_id": "u"})
    with pytest.raises(avro.AvroError):
        avro.decode_record(FIELDS, body[:-2])


def _env(spark, rows):
    return spark.createDataFrame(
        [(None, 0, i, r) for i, r in enumerate(rows)],
        "kafka_timestamp timestamp, kafka_partition int, kafka_offset long, raw_bytes binary")


def test_each_reason(spark):
    good = avro.encode_record(FIELDS, {"event_id": "e1", "event_timestamp": "2024-01-01T00:00:00+00:00",
                                       "user_id": "u1", "amount": 5.0, "merchant_category": "fuel"})
    h1 = b"\x00" + struct.pack(">I", 1)
    msgs = [
        None,                                   # null_value
        b"\x00\x00",                            # too_short
        b"\x01" + struct.pack(">I", 1) + good,  # bad_magic
        b"\x00" + struct.pack(">I", 999) + good,  # unknown_schema
        h1 + good[:-3],                         # decode_error (truncated)
        h1,                                     # exactly 5 bytes -> decode_error
        h1 + good,                              # accepted
        h1 + avro.encode_record(FIELDS, {"event_id": "e2", "event_timestamp": "junk",
                                         "user_id": "u"}),  # contract_violation
    ]
    dec = wire.decode(_env(spark, msgs), REGISTRY_V1)
    reasons = [r._reason for r in dec.orderBy("kafka_offset").collect()]
    assert reasons == ["null_value", "too_short", "bad_magic", "unknown_schema",
                       "decode_error", "decode_error", None, "contract_violation"]
    acc = wire.accepted(dec).first()
    assert acc.event_id == "e1" and acc.amount == 5.0
    assert str(acc.event_timestamp) == "2024-01-01 00:00:00"
    q = QU.quarantined(dec).filter("reason = 'contract_violation'").first()
    assert q.violation_summary == "event_timestamp:unparseable_timestamp"
    assert q.raw_value == bytearray(msgs[-1])


def test_schema_evolution_extra_and_missing_fields(spark):
    v2 = json.loads(wire.TRANSACTION_SCHEMA_JSON)
    v2["fields"].append({"name": "risk_hint", "type": ["null", "string"], "default": None})
    v3 = json.loads(wire.TRANSACTION_SCHEMA_JSON)
    v3["fields"] = [f for f in v3["fields"] if f["name"] != "terminal_id"]
    f2, f3 = avro.parse_schema(v2), avro.parse_schema(v3)
    base = {"event_id": "e", "event_timestamp": "2024-01-01T00:00:00Z", "user_id": "u",
            "terminal_id": "T1", "risk_hint": "x"}
    msgs = [b"\x00" + struct.pack(">I", 2) + avro.encode_record(f2, base),
            b"\x00" + struct.pack(">I", 3) + avro.encode_record(f3, base)]
    reg = {1: wire.TRANSACTION_SCHEMA_JSON, 2: json.dumps(v2), 3: json.dumps(v3)}
    rows = wire.accepted(wire.decode(_env(spark, msgs), reg)).orderBy("kafka_offset").collect()
    assert [r.terminal_id for r in rows] == ["T1", None]
    assert "risk_hint" not in rows[0].asDict()


def test_fixture_round_trip_equals_projection(spark):
    from ledgerlake.sources.tables import transactions_from_events
    ev = read_table(spark, SF001, "events")
    back = wire.accepted(wire.decode(envelope_from_events(ev, defects=False), REGISTRY_V1))
    cols = [c for c in back.columns if not c.startswith("kafka_")]
    orig = transactions_from_events(ev).filter("event_id IS NOT NULL").select(*cols)
    assert back.select(*cols).exceptAll(orig).count() == 0
    assert orig.exceptAll(back.select(*cols)).count() == 0


def test_replay_recovers_unknown_schema_once(spark):
    ev = read_table(spark, SF001, "events")
    dec = wire.decode(envelope_from_events(ev), REGISTRY_V1)
    q = QU.quarantined(dec)
    rec = wire.accepted(QU.replay(q, REGISTRY_FIXED))
    n = rec.count()
    assert n == q.filter("reason = 'unknown_schema'").count() and n > 0
    again = wire.accepted(QU.replay(q, REGISTRY_FIXED, already_accepted=rec))
    assert again.count() == 0


def test_replay_with_fix(spark):
    ev = read_table(spark, SF001, "events")
    q = QU.quarantined(wire.decode(envelope_from_events(ev), REGISTRY_V1))
    fixed = QU.replay(q, REGISTRY_V1, fix=lambda raw: F.concat(F.unhex(F.lit("00")), F.substring(raw, 2, 1 << 30)))
    assert wire.accepted(fixed).count() == q.filter("reason = 'bad_magic'").count()


def test_retention(spark, scratch):
    df = spark.createDataFrame(
        [(b"x", 0, 1, "bad_magic", None, None), (b"y", 0, 2, "too_short", None, None)],
        "raw_value binary, kafka_partition int, kafka_offset long, reason string, "
        "violations array<struct<field:string,rule:string>>, violation_summary string")
    df = df.withColumn("detected_at", F.when(F.col("kafka_offset") == 1,
                                              F.lit("2024-01-01 00:00:00")).otherwise(
                                              F.lit("2024-05-01 00:00:00")).cast("timestamp")) \
           .withColumn("detected_date", F.to_date("detected_at"))
    assert QU.expire(df, "2024-05-10").count() == 1
    QU.write_quarantine(df, scratch)
    dropped = QU.drop_expired_partitions(spark, scratch, "2024-05-10")
    assert dropped == ["detected_date=2024-01-01"]
    assert spark.read.parquet(scratch).count() == 1


def test_registry_size_bound():
    with pytest.raises(ValueError):
        wire.load_registry({i: "x" for i in range(wire.MAX_SCHEMAS + 1)})


def test_writer_type_mismatch_and_widening(spark):
    as_text = json.loads(wire.TRANSACTION_SCHEMA_JSON)
    as_long = json.loads(wire.TRANSACTION_SCHEMA_JSON)
    for f in as_text["fields"]:
        if f["name"] == "amount":
            f["type"] = ["null", "string"]
    for f in as_long["fields"]:
        if f["name"] == "amount":
            f["type"] = ["null", "long"]
    base = {"event_id": "e", "event_timestamp": "2024-01-01T00:00:00Z", "user_id": "u"}
    msgs = [b"\x00" + struct.pack(">I", 4) + avro.encode_record(avro.parse_schema(as_text), {**base, "amount": "12.5"}),
            b"\x00" + struct.pack(">I", 5) + avro.encode_record(avro.parse_schema(as_long), {**base, "amount": 12})]
    reg = {4: json.dumps(as_text), 5: json.dumps(as_long)}
    dec = wire.decode(_env(spark, msgs), reg).orderBy("kafka_offset").collect()
    assert [(r._reason, r.amount) for r in dec] == [(None, 12.5), (None, 12.0)]


def test_columns_equal_the_message_reader_on_damaged_bodies():
    import random

    import numpy as np
    r = random.Random(9)
    schema = {"type": "record", "name": "x", "fields": [
        {"name": "event_id", "type": "string"}, {"name": "amount", "type": ["null", "double", "long"]},
        {"name": "is_online", "type": "boolean"}, {"name": "user_id", "type": ["null", "string"]},
        {"name": "other", "type": ["bytes", "float", "int"]}]}
    fields = avro.parse_schema(schema)
    bodies = []
    for _ in range(600):
        b = bytearray(avro.encode_record(fields, {
            "event_id": r.choice(["", "a", "é\U0001F600" * 40, "x" * 200]),
            "amount": r.choice([None, 1.5, 7, -(1 << 40)]), "is_online": r.random() < 0.5,
            "user_id": r.choice([None, "u"]), "other": r.choice([b"\xff\x00", 3, -5])}))
        for _ in range(r.choice([0, 0, 1, 2])):
            how = r.randrange(3)
            if how == 0 and b:
                b[r.randrange(len(b))] = r.randrange(256)
            elif how == 1:
                b = b[:r.randrange(len(b) + 1)]
            else:
                b += bytes([r.randrange(256)])
        bodies.append(bytes(b))
    edge = np.cumsum([0, *map(len, bodies)])
    data = np.frombuffer(b"".join(bodies), np.uint8)
    plan = resolve.Plan(schema, resolve.parse(wire.TRANSACTION_SCHEMA_JSON), wire._TARGETS)
    columns, wrong, ok = plan.columns(data, edge[:-1], edge[1:])
    one = avro.compile_decoder(fields)
    good = 0
    for i, b in enumerate(bodies):
        try:
            want = one(memoryview(b))
        except (avro.AvroError, IndexError, struct.error):
            assert not ok[i]
            continue
        assert ok[i], (i, want)
        good += 1
        assert columns["event_id"][i].as_py() == want[0] and columns["is_online"][i].as_py() == want[2]
        assert columns["user_id"][i].as_py() == want[3]
        a = columns["amount"][i].as_py()
        assert a == (None if want[1] is None else float(want[1])) or a != a
    assert 200 < good < 590


def test_other_writer_types_are_cast_and_other_fields_read_past(spark):
    schema = {"type": "record", "name": "t", "fields": [
        {"name": "event_id", "type": "long"}, {"name": "event_timestamp", "type": "string"},
        {"name": "user_id", "type": {"type": "string", "logicalType": "uuid"}},
        {"name": "amount", "type": "string"}, {"name": "is_online", "type": "string"},
        {"name": "currency", "type": "boolean"}]}
    more = json.loads(json.dumps(schema))
    more["fields"][1:1] = [
        {"name": "tags", "type": {"type": "array", "items": "string"}},
        {"name": "m", "type": ["null", {"type": "map", "values": "long"}]},
        {"name": "e", "type": {"type": "enum", "name": "e", "symbols": ["a", "b"]}},
        {"name": "f", "type": {"type": "fixed", "name": "f", "size": 3}},
        {"name": "n", "type": {"type": "record", "name": "n", "fields": [{"name": "k", "type": "int"}]}}]

    def text(x):
        return bytes([2 * len(x)]) + x.encode()

    def body(amount, online, extra=b""):
        return bytes([14]) + extra + text("2024-01-01T00:00:00Z") + text("u") + text(amount) + text(online) + b"\x01"

    extra = b"\x04" + text("p") + text("q") + b"\x00" + b"\x02" + b"\x01\x06" + text("k") + b"\x08" + b"\x00" + b"\x02" + b"abc" + b"\x0a"
    assert avro.compile_decoder(avro.parse_schema(more))(body("1.5", "true", extra))[-2:] == ["true", True]
    h = [b"\x00" + struct.pack(">I", i) for i in range(5)]
    msgs = [h[1] + body("12.5", "true"), h[1] + body("x", "maybe"), h[2] + body("3", "false", extra),
            h[3] + body("3", "false"), h[4] + body("3", "false")]
    reg = {1: json.dumps(schema), 2: json.dumps(more), 3: '{"type": "string"}'}
    rows = wire.decode(_env(spark, msgs), reg).orderBy("kafka_offset").collect()
    assert [r._reason for r in rows] == [None, "contract_violation", None, "unreadable_schema", "unknown_schema"]
    assert [(r.event_id, r.amount, r.is_online, r.currency) for r in rows[:3]] == [
        ("7", 12.5, True, "true"), ("7", None, None, "true"), ("7", 3.0, False, "true")]
    assert sorted((v.field, v.rule) for v in rows[1]._violations) == [("amount", "bad_type"), ("is_online", "bad_type")]
