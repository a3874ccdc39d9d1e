"""Wire format: ``0x00`` + 4-byte big-endian schema id + Avro body.

* W1 header checks are native expressions (length, magic byte, schema id via
  ``conv(hex(...))`` as a long, i.e. unsigned 32-bit) -- no Python.
* W2 the schema registry is a DataFrame ``(schema_id, schema_json)``.  It is
  tiny by nature (one row per schema version); its row count and text size
  are checked before it is shipped to executors as a broadcast variable.
  Tasks never call a network service.
* W3 bodies are decoded in ``mapInArrow``, column by column over the batch's
  byte buffer: pass-through columns and texts are never converted to Python
  objects, and a bad message becomes a reason string, never an exception in
  the task.  A writer's type other than the contract's is cast through text;
  what does not parse is a ``bad_type`` violation.
* W4 encoding is the same in reverse.
"""

from __future__ import annotations

import json
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.functions import avro, resolve
from ledgerlake.session import spread
from ledgerlake.schemas import HEADER_BYTES, REQUIRED_FIELDS, TRANSACTION_FIELDS

# Fixed value: the writer schema of the transaction topic (version 1).
TRANSACTION_AVRO_SCHEMA = {
    "type": "record",
    "name": "TransactionEvent",
    "fields": [
        {"name": "event_id", "type": "string"},
        {"name": "event_timestamp", "type": "string"},
        {"name": "user_id", "type": "string"},
        {"name": "merchant_id", "type": ["null", "string"], "default": None},
        {"name": "merchant_category", "type": ["null", "string"], "default": None},
        {"name": "amount", "type": ["null", "double"], "default": None},
        {"name": "currency", "type": ["null", "string"], "default": None},
        {"name": "country_code", "type": ["null", "string"], "default": None},
        {"name": "card_type", "type": ["null", "string"], "default": None},
        {"name": "is_online", "type": ["null", "boolean"], "default": None},
        {"name": "device_type", "type": ["null", "string"], "default": None},
        {"name": "ip_address", "type": ["null", "string"], "default": None},
        {"name": "_is_fraud_label", "type": ["null", "boolean"], "default": None},
        {"name": "terminal_id", "type": ["null", "string"], "default": None},
    ],
}
TRANSACTION_SCHEMA_JSON = json.dumps(TRANSACTION_AVRO_SCHEMA)

# Registry size bound: a broadcast lookup must stay small whatever the data.
MAX_SCHEMAS = 10_000
MAX_REGISTRY_BYTES = 16 * 1024 * 1024

# On the wire the timestamp is ISO-8601 text; it is typed after decoding.
WIRE_TYPES = {n: (T.StringType() if n == "event_timestamp" else t)
              for n, t, _ in TRANSACTION_FIELDS}
_ARROW = {T.StringType(): pa.string(), T.DoubleType(): pa.float64(),
          T.BooleanType(): pa.bool_(), T.TimestampType(): pa.timestamp("us")}

REASONS = ("null_value", "too_short", "bad_magic", "unknown_schema", "unreadable_schema", "decode_error")


def header_reason(raw: Column) -> Column:
    """Failure reason from the header alone, NULL when the header is fine."""
    return (F.when(raw.isNull(), F.lit("null_value"))
            .when(F.octet_length(raw) < HEADER_BYTES, F.lit("too_short"))
            .when(F.hex(F.substring(raw, 1, 1)) != F.lit("00"), F.lit("bad_magic")))


def header_schema_id(raw: Column) -> Column:
    """Bytes 1-4 as an unsigned big-endian integer (long)."""
    return F.conv(F.hex(F.substring(raw, 2, 4)), 16, 10).try_cast("long")


def load_registry(schemas: DataFrame | dict) -> dict[int, str]:
    """Schema registry as a dict, after checking its size bound."""
    if isinstance(schemas, dict):
        reg = {int(k): (v if isinstance(v, str) else json.dumps(v)) for k, v in schemas.items()}
    else:
        rows = schemas.select("schema_id", "schema_json").limit(MAX_SCHEMAS + 1).collect()
        reg = {int(r[0]): r[1] for r in rows}
    if len(reg) > MAX_SCHEMAS or sum(len(v) for v in reg.values()) > MAX_REGISTRY_BYTES:
        raise ValueError("schema registry exceeds the broadcast size bound")
    return reg


#: contract columns as the reader sees them on the wire
_TARGETS = {n: {T.StringType(): resolve.STRING, T.DoubleType(): resolve.DOUBLE, T.BooleanType(): resolve.BOOLEAN}[t]
            for n, t in WIRE_TYPES.items()}


_SPARK = {resolve.STRING: T.StringType(), resolve.DOUBLE: T.DoubleType(), resolve.BOOLEAN: T.BooleanType()}


def reader_targets(reader: str | dict) -> dict[str, str]:
    """Columns that a reader schema asks for: the contract's, and those it adds (text,
    numbers and booleans; other types as text)."""
    kinds = {"boolean": resolve.BOOLEAN, **dict.fromkeys(("int", "long", "float", "double"), resolve.DOUBLE)}
    added = {f["name"]: next((kinds[b["kind"]] for b in resolve._branches(f["type"]) if b["kind"] in kinds), resolve.STRING)
             for f in resolve.parse(reader)["fields"] if f["name"] not in WIRE_TYPES}
    return {**_TARGETS, **added}


def _decoder(registry_bc, reader_json: str, raw_name: str, passthrough: list[str]):
    def run(batches):
        reader, targets = resolve.parse(reader_json), reader_targets(reader_json)
        names = list(targets)
        plans: dict[int, object] = {}
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            raw = batch.column(raw_name).cast(pa.large_binary())
            edges = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + n + 1]
            data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
            reasons = np.array(batch.column("_reason").to_pylist(), object)
            sids = np.array([-1 if x is None else x for x in batch.column("_schema_id").to_pylist()], np.int64)
            bad = np.full(n, None, object)
            parts, order = [], []
            for sid in np.unique(sids[reasons == None]):                       # noqa: E711
                if sid not in plans:
                    try:
                        text = registry_bc.value.get(int(sid))
                        plans[sid] = "unknown_schema" if text is None else resolve.Plan(text, reader, targets)
                    except (avro.AvroError, ValueError, KeyError, TypeError, AttributeError):
                        plans[sid] = "unreadable_schema"
                rows = np.flatnonzero((sids == sid) & (reasons == None))       # noqa: E711
                if isinstance(plans[sid], str):
                    reasons[rows] = plans[sid]
                    continue
                columns, wrong, ok = plans[sid].columns(data, edges[rows] + HEADER_BYTES, edges[rows + 1])
                reasons[rows[~ok]] = "decode_error"
                for name in names:
                    for i in np.flatnonzero(wrong[name] & ok):
                        bad[rows[i]] = [*(bad[rows[i]] or []), name]
                parts.append({k: columns[k].filter(pa.array(ok)) for k in names})
                order.append(rows[ok])
            take = np.full(n, -1, np.int64)
            where = np.concatenate(order) if order else np.empty(0, np.int64)
            take[where] = np.arange(len(where))
            index = pa.array(take, mask=take < 0)
            arrays = [batch.column(p) for p in passthrough]
            arrays += [pa.concat_arrays([p[k] for p in parts]).take(index) if parts else pa.nulls(n, _ARROW[_SPARK[targets[k]]])
                       for k in names]
            arrays += [pa.array(reasons.tolist(), pa.string()), pa.array(bad.tolist(), pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(arrays, names=passthrough + names + ["_reason", "_bad_fields"])
    return run


def decode(envelope: DataFrame, schemas: DataFrame | dict, raw: str = "raw_bytes",
           reader: str | dict = TRANSACTION_SCHEMA_JSON) -> DataFrame:
    """W1-W3 + P3/P5: envelope rows -> typed transaction columns plus
    ``_reason`` (NULL for a good row; a decode reason or
    ``contract_violation``) and ``_violations`` (array of (field, rule)).

    Every input row comes out exactly once, so the caller routes the result
    with two filters (``accepted``/``quarantined``) over one persisted or
    written frame.

    ``reader`` is the schema that bodies are resolved to, whatever version they
    were written under: its aliases find renamed fields, its defaults fill fields
    that a writer lacks (``functions.resolve``), and fields that it has beyond the
    contract become further columns.
    """
    spark = envelope.sparkSession
    reg = load_registry(schemas)
    bc = spark.sparkContext.broadcast(reg)
    reader = reader if isinstance(reader, str) else json.dumps(reader)
    columns = {n: _SPARK[t] for n, t in reader_targets(reader).items()}
    passthrough = [c for c in envelope.columns if c not in columns]
    staged = spread(envelope).select(*passthrough,
                             header_reason(F.col(raw)).alias("_reason"),
                             header_schema_id(F.col(raw)).alias("_schema_id"))
    out_schema = T.StructType(
        [staged.schema[p] for p in passthrough]
        + [T.StructField(n, t, True) for n, t in columns.items()]
        + [T.StructField("_reason", T.StringType(), True),
           T.StructField("_bad_fields", T.ArrayType(T.StringType()), True)])
    decoded = staged.mapInArrow(_decoder(bc, reader, raw, passthrough), out_schema)
    ts_text = F.col("event_timestamp")
    ts = F.try_to_timestamp(ts_text)
    decoded = decoded.withColumn("_ts_text", ts_text).withColumn("event_timestamp", ts)
    violations = F.filter(F.array(
        *[F.when(F.col(f).isNull(), F.struct(F.lit(f).alias("field"),
                                             F.lit("required_null").alias("rule")))
          for f in REQUIRED_FIELDS
          if f != "event_timestamp"],
        F.when(F.col("_ts_text").isNull(),
               F.struct(F.lit("event_timestamp").alias("field"), F.lit("required_null").alias("rule")))
         .when(F.col("event_timestamp").isNull(),
               F.struct(F.lit("event_timestamp").alias("field"),
                        F.lit("unparseable_timestamp").alias("rule")))),
        lambda x: x.isNotNull())
    bad_types = F.transform(F.coalesce(F.col("_bad_fields"), F.array().cast("array<string>")),
                            lambda f: F.struct(f.alias("field"), F.lit("bad_type").alias("rule")))
    all_v = F.when(F.col("_reason").isNull(), F.concat(violations, bad_types))
    return (decoded
            .withColumn("_violations", all_v)
            .withColumn("_reason", F.coalesce(
                F.col("_reason"),
                F.when(F.size(F.col("_violations")) > 0, F.lit("contract_violation"))))
            .drop("_bad_fields", "_ts_text"))


def accepted(decoded: DataFrame, raw: str = "raw_bytes") -> DataFrame:
    """Rows that decoded and meet the contract (raw bytes dropped, P6)."""
    return decoded.filter(F.col("_reason").isNull()).drop("_reason", "_violations", raw)


def _encoded(name: str, branches: tuple, column: pa.Array) -> pa.Array:
    """A column's values as Avro binary, NULL where one fits no branch."""
    if pa.types.is_string(column.type) or pa.types.is_boolean(column.type):
        seen = column.dictionary_encode(null_encoding="encode")
        return pa.array(avro.encode_values(name, branches, seen.dictionary.to_pylist()), pa.binary()).take(seen.indices)
    return pa.array(avro.encode_values(name, branches, column.to_pylist()), pa.binary())


def encode(df: DataFrame, schema_id: int = 1, schema_json: str | dict = TRANSACTION_SCHEMA_JSON,
           value: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Rows with transaction columns -> ``keep`` columns + ``value``
    (header + Avro body).  A record that does not fit the writer schema (e.g.
    a NULL in a required field) yields a NULL value: it cannot be produced."""
    fields = avro.parse_schema(schema_json)
    header = b"\x00" + struct.pack(">I", int(schema_id))
    keep = list(keep or [])
    names = [n for n, _, _ in fields]
    cols = []
    for n in names:
        if n == "event_timestamp" and dict(df.dtypes).get(n, "").startswith("timestamp"):
            cols.append(F.date_format(F.col(n), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx").alias(n))
        elif n in df.columns:
            cols.append(F.col(n))
        else:
            cols.append(F.lit(None).alias(n))
    staged = spread(df).select(*[F.col(k).alias(f"_k_{k}") for k in keep], *cols)
    out_schema = T.StructType(
        [T.StructField(k, staged.schema[f"_k_{k}"].dataType, True) for k in keep]
        + [T.StructField(value, T.BinaryType(), True)])

    def run(batches):
        for batch in batches:
            # column by column: texts and flags once for each value; NULL where any part is
            parts = [_encoded(n, branches, batch.column(n)) for n, branches, _ in fields]
            whole = pc.binary_join_element_wise(pa.array([header] * batch.num_rows, pa.binary()), *parts, b"")
            arrays = [batch.column(f"_k_{k}") for k in keep] + [whole]
            yield pa.RecordBatch.from_arrays(arrays, names=keep + [value])
    return staged.mapInArrow(run, out_schema)
