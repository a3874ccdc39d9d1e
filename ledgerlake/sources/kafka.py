"""Message sources (S1, S2, W5) and the wire fixture derived from ``events``.

The Kafka connector is not on this classpath; ``read_kafka_stream`` is the
production entry, and every downstream operator takes *any* DataFrame with the
envelope columns, so tests drive the same code from Parquet/file streams.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import wire
from ledgerlake.schemas import TRANSACTION_SCHEMA
from ledgerlake.sources.tables import transactions_from_events

# Source options of the topic.
KAFKA_OPTIONS = {
    "startingOffsets": "latest",
    "failOnDataLoss": "false",
    "kafka.reconnect.backoff.ms": "1000",
    "kafka.reconnect.backoff.max.ms": "10000",
    "kafka.request.timeout.ms": "60000",
}


def envelope(df: DataFrame) -> DataFrame:
    """Kafka columns renamed; the value stays binary."""
    return df.select(
        F.col("timestamp").alias("kafka_timestamp"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("value").alias("raw_bytes"))


def read_kafka_stream(spark: SparkSession, bootstrap_servers: str, topic: str,
                      options: dict | None = None,
                      min_partitions: int | None = None) -> DataFrame:
    """One topic as a stream of envelope rows.

    ``min_partitions`` (Kafka's ``minPartitions``) splits the offset ranges of
    a topic with few partitions over more tasks, so the Python decode runs on
    every core without a shuffle.
    """
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("subscribe", topic))
    if min_partitions:
        reader = reader.option("minPartitions", str(int(min_partitions)))
    for k, v in {**KAFKA_OPTIONS, **(options or {})}.items():
        reader = reader.option(k, v)
    return envelope(reader.load())


# -- W5: NDJSON landing path ------------------------------------------------------
LANDING_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"   # keeps microseconds


def write_landing_json(tx: DataFrame, path: str) -> None:
    """Raw landing copy as newline-delimited JSON (no decode)."""
    tx.write.mode("append").option("timestampFormat", LANDING_TS_FORMAT).json(path)


def read_landing_json(spark: SparkSession, path: str) -> DataFrame:
    """Read NDJSON with the contract schema; malformed lines land in
    ``_corrupt_record`` instead of failing the job."""
    schema = T.StructType(list(TRANSACTION_SCHEMA.fields)
                          + [T.StructField("_corrupt_record", T.StringType(), True)])
    return (spark.read.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", "_corrupt_record")
            .option("timestampFormat", LANDING_TS_FORMAT)
            .json(path))


# -- wire fixture -------------------------------------------------------------------
# Envelope position of an event: 4 topic partitions, offsets dense within each.
PARTITIONS = 4

# Planted wire defects by ``event_id % 997`` (see FIXTURES.md):
# 1 null_value, 2 too_short, 3 bad_magic, 4 unknown_schema (id 999),
# 5 truncated body, 6 header only, 7 unparseable timestamp text.
DEFECT_MODULUS = 997
UNKNOWN_SCHEMA_ID = 999


def envelope_from_events(events: DataFrame, defects: bool = True) -> DataFrame:
    """Encode every event as a wire message under schema id 1.

    With ``defects`` a deterministic share of messages is corrupted so every
    quarantine reason occurs; the source ``event_id`` is kept as ``_src_id``.
    """
    tx = transactions_from_events(events, keep=["event_id AS _src_id", "ts AS _src_ts"])
    if defects:
        k = F.col("_src_id") % DEFECT_MODULUS
        tx = tx.withColumn("event_timestamp", F.when(
            k == 7, F.lit("not-a-time")).otherwise(
            F.date_format("event_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")))
    enc = wire.encode(tx, schema_id=1, keep=["_src_id", "_src_ts"])
    v = F.col("value")
    if defects:
        k = F.col("_src_id") % DEFECT_MODULUS
        v = (F.when(k == 1, F.lit(None).cast("binary"))
             .when(k == 2, F.substring(v, 1, 3))
             .when(k == 3, F.concat(F.unhex(F.lit("01")), F.substring(v, 2, 1 << 30)))
             .when(k == 4, F.concat(F.unhex(F.lit("00000003E7")), F.substring(v, 6, 1 << 30)))
             .when(k == 5, v.substr(F.lit(1), F.octet_length(v) - 3))
             .when(k == 6, F.substring(v, 1, 5))
             .otherwise(v))
    return enc.select(
        F.col("_src_ts").cast("timestamp").alias("kafka_timestamp"),
        (F.col("_src_id") % PARTITIONS).cast("int").alias("kafka_partition"),
        F.floor(F.col("_src_id") / PARTITIONS).cast("long").alias("kafka_offset"),
        v.alias("raw_bytes"))


# -- a topic of three schema versions ------------------------------------------------
# Versions of the transaction schema as the fixture evolves it.  2: a field is renamed and
# one dropped, the order changes, and nested fields arrive.  3: amounts are decimals, times
# are numbers, the card type is an enum, an address is bytes.
def _fields(*changes) -> list[dict]:
    held = {f["name"]: f for f in wire.TRANSACTION_AVRO_SCHEMA["fields"]}
    return [c if isinstance(c, dict) else held[c] for c in changes]


VERSION_2 = {"type": "record", "name": "TransactionEvent", "fields": _fields(
    "user_id", "event_id", {"name": "category", "type": ["null", "string"], "default": None}, "event_timestamp",
    {"name": "device", "type": {"type": "record", "name": "Device", "fields": [
        {"name": "os", "type": "string"}, {"name": "screen", "type": {"type": "array", "items": "int"}}]}},
    "merchant_id", {"name": "amount", "type": ["double", "null"]}, "country_code", "card_type", "is_online",
    {"name": "labels", "type": {"type": "map", "values": ["null", "string"]}}, "device_type", "ip_address", "_is_fraud_label")}
VERSION_3 = {"type": "record", "name": "TransactionEvent", "fields": _fields(
    "event_id", {"name": "event_timestamp", "type": {"type": "long", "logicalType": "timestamp-micros"}}, "user_id", "merchant_id",
    {"name": "category", "type": "string"},
    {"name": "amount", "type": ["null", {"type": "bytes", "logicalType": "decimal", "precision": 18, "scale": 2}]}, "currency", "country_code",
    {"name": "card_type", "type": {"type": "enum", "name": "Card", "symbols": ["credit", "debit", "prepaid"]}}, "is_online", "device_type",
    {"name": "ip_address", "type": ["null", "bytes"]}, "_is_fraud_label",
    {"name": "channel", "type": ["null", "string"], "default": None})}
#: the reader: the contract, with the renamed field's new name, and a default currency
READER = {**wire.TRANSACTION_AVRO_SCHEMA, "fields": [
    f | ({"aliases": ["category"]} if f["name"] == "merchant_category" else {"type": ["string", "null"], "default": "USD"}
         if f["name"] == "currency" else {}) for f in wire.TRANSACTION_AVRO_SCHEMA["fields"]]}
VERSIONS = {1: wire.TRANSACTION_AVRO_SCHEMA, 2: VERSION_2, 3: VERSION_3}
#: the contract and one more field, as a later producer writes and a later job reads it
CHANNEL_READER = {**wire.TRANSACTION_AVRO_SCHEMA, "fields": [
    *wire.TRANSACTION_AVRO_SCHEMA["fields"], {"name": "channel", "type": ["null", "string"], "default": None}]}


def versioned_envelope_from_events(events: DataFrame) -> DataFrame:
    """Events as messages of a topic whose producers moved from version 1 to 3:
    ``event_id % 3`` says under which one an event was written."""
    tx = transactions_from_events(events, keep=["event_id AS _src_id", "ts AS _src_ts"])
    version = (F.col("_src_id") % 3 + 1).cast("int")
    cents = F.round(F.col("amount") * 100).cast("long")
    low = F.hex(cents)
    digits = F.when(cents < 0, F.lpad(low, 16, "F")).otherwise(F.lpad(low, 16, "0"))
    parts = []
    for v, schema in VERSIONS.items():
        rows = tx.where(version == v)
        if v > 1:
            rows = rows.withColumn("category", F.coalesce("merchant_category", F.lit("unknown")) if v == 3 else F.col("merchant_category"))
        if v == 2:
            rows = rows.withColumns({
                "device": F.struct(F.lit("os-") .alias("os"), F.transform(F.sequence(F.lit(1), (F.col("_src_id") % 4 + 1).cast("int")),
                                                                         lambda x: x).alias("screen")),
                "labels": F.create_map(F.lit("source"), F.col("device_type"), F.lit("none"), F.lit(None).cast("string"))})
        if v == 3:
            rows = rows.withColumns({"event_timestamp": F.unix_micros("event_timestamp"), "amount": F.unhex(digits),
                                     "ip_address": F.col("ip_address").cast("binary"), "channel": F.lit("web")})
        parts.append(wire.encode(rows, schema_id=v, schema_json=schema, keep=["_src_id", "_src_ts"]))
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return out.select(F.col("_src_ts").cast("timestamp").alias("kafka_timestamp"),
                      (F.col("_src_id") % PARTITIONS).cast("int").alias("kafka_partition"),
                      F.floor(F.col("_src_id") / PARTITIONS).cast("long").alias("kafka_offset"), F.col("value").alias("raw_bytes"))


def channel_envelope_from_events(events: DataFrame) -> DataFrame:
    """Events under ``CHANNEL_READER`` as schema 4, with the channel filled."""
    tx = transactions_from_events(events, keep=["event_id AS _src_id", "ts AS _src_ts"])
    rows = tx.withColumn("channel", F.when(F.col("is_online"), "web").otherwise("pos"))
    out = wire.encode(rows, schema_id=4, schema_json=CHANNEL_READER, keep=["_src_id", "_src_ts"])
    return out.select(F.col("_src_ts").cast("timestamp").alias("kafka_timestamp"),
                      (F.col("_src_id") % PARTITIONS).cast("int").alias("kafka_partition"),
                      F.floor(F.col("_src_id") / PARTITIONS).cast("long").alias("kafka_offset"), F.col("value").alias("raw_bytes"))
