"""Change-data-capture operators D1-D5, J2, N2.

Change events have the connector shape ``{before, after, op, source{...}}``
with ``op`` in c (insert), u (update), d (delete), r (snapshot read).

Latest-per-key (N2) is an aggregate, not a window: ``max(struct(lsn, seq,
op, after))`` is combinable, so each task keeps one row per key before the
shuffle.  A key that owns a third of all changes therefore costs one row per
task in the exchange, where a ``row_number`` window would pull all its
changes into a single task.  Ties on LSN break on ``seq`` (source position).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

OPS = ("c", "u", "d", "r")


def change_schema(row: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField("before", row, True),
        T.StructField("after", row, True),
        T.StructField("op", T.StringType(), True),
        T.StructField("source", T.StructType([
            T.StructField("connector", T.StringType(), True),
            T.StructField("table", T.StringType(), True),
            T.StructField("txId", T.LongType(), True),
            T.StructField("lsn", T.LongType(), True),
        ]), True),
        T.StructField("ts_ms", T.LongType(), True),
    ])


def _parsed_once(messages: DataFrame, row: T.StructType, value: str, extra: list) -> DataFrame:
    """``_c`` = the parsed message, evaluated once: it comes out of a
    one-element ``inline`` so later filters on its fields (validity, LSN
    ranges) stay above it and never re-run the JSON parser per predicate."""
    schema = T.StructType(change_schema(row).fields
                          + [T.StructField("_corrupt", T.StringType(), True)])
    parsed = F.from_json(F.col(value), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return messages.select(F.inline(F.array(F.struct(parsed.alias("_c"), *extra))))


def _reason(key: list[str], value: Column) -> Column:
    """Why a message cannot be applied; the key columns are already resolved.
    ``tombstone`` marks the NULL value that follows a delete: no fault."""
    op, image = F.col("_c.op"), F.col("_c.after")
    no_key = F.lit(False)
    for k in key:
        no_key = no_key | F.col(k).isNull()
    return (F.when(value.isNull(), "tombstone")
            .when(F.col("_c").isNull() | F.col("_c._corrupt").isNotNull() | op.isNull(), "bad_json")
            .when(~op.isin(*OPS), "bad_op")
            .when(no_key, "missing_key")
            .when(F.col("_c.source.lsn").isNull(), "missing_lsn")
            .when((op != "d") & image.isNull(), "missing_after"))


RAW_COLUMNS = ("raw_value", "kafka_partition", "kafka_offset")


def parse_messages(messages: DataFrame, row: T.StructType, key: list[str],
                   value: str = "value", message_key: str | None = "key",
                   seq: str | None = "kafka_offset") -> DataFrame:
    """D1 with the original message beside it (``RAW_COLUMNS``): parsed once, so
    that a batch can go to the log and to quarantine from one pass."""
    for c in ("kafka_partition", "kafka_offset"):
        if c not in messages.columns:
            messages = messages.withColumn(c, F.lit(None).cast("int" if c == "kafka_partition" else "long"))
    place = F.col(seq).cast("long") if seq and seq in messages.columns else F.lit(0).cast("long")
    keyed = _keyed(messages, row, key, value, message_key,
                   [place.alias("seq"), F.col("kafka_partition"), F.col("kafka_offset")])
    return keyed.select(*key, F.col("_c.op").alias("op"), F.col("_c.before").alias("before"),
                        F.col("_c.after").alias("after"), F.col("_c.source.lsn").alias("lsn"),
                        F.col("_c.source.txId").alias("tx_id"), F.col("_c.source.table").alias("table"), "seq",
                        F.col("_value").cast("binary").alias("raw_value"), "kafka_partition", "kafka_offset",
                        _reason(key, F.col("_value")).alias("_reason"))


def parse_changes(messages: DataFrame, row: T.StructType, key: list[str],
                  value: str = "value", message_key: str | None = "key",
                  seq: str | None = "kafka_offset") -> DataFrame:
    """JSON change messages -> ``(<key>, op, before, after, lsn, tx_id,
    table, seq, _reason)``.

    The key comes from the message key when present (a delete may carry a
    NULL or key-only ``before``), else from ``after``/``before``.  A message
    that cannot be applied gets a ``_reason``: ``bad_json``, ``bad_op``,
    ``missing_key``, ``missing_lsn`` or ``missing_after`` (route those to
    quarantine), or ``tombstone`` (the NULL value after a delete, dropped);
    nothing raises.
    """
    return parse_messages(messages, row, key, value, message_key, seq).drop(*RAW_COLUMNS)


def _keyed(messages: DataFrame, row: T.StructType, key: list[str], value: str,
           message_key: str | None, extra: list) -> DataFrame:
    """The parsed message ``_c``, its text ``_value`` and the resolved key columns."""
    key_schema = T.StructType([row[k] for k in key])
    mk = (F.from_json(F.col(message_key), key_schema, {"mode": "PERMISSIVE"})
          if message_key and message_key in messages.columns else F.lit(None).cast(key_schema))
    once = _parsed_once(messages, row, value, [mk.alias("_mk"), F.col(value).alias("_value"), *extra])
    return once.select("*", *[F.coalesce(F.col("_mk")[k], F.col("_c.after")[k], F.col("_c.before")[k]).alias(k)
                              for k in key])


def rejected(parsed: DataFrame) -> DataFrame:
    """Q1 for parsed messages: those that cannot be applied in the quarantine
    shape (original text kept as bytes, position, reason, detection time)."""
    return (parsed.filter(F.col("_reason").isNotNull() & (F.col("_reason") != "tombstone"))
            .select("raw_value", "kafka_partition", "kafka_offset", F.col("_reason").alias("reason"))
            .withColumn("violations", F.lit(None).cast("array<struct<field:string,rule:string>>"))
            .withColumn("violation_summary", F.lit(None).cast("string"))
            .withColumn("detected_at", F.current_timestamp())
            .withColumn("detected_date", F.to_date("detected_at")))


def quarantined_changes(messages: DataFrame, row: T.StructType, key: list[str],
                        value: str = "value", message_key: str | None = "key") -> DataFrame:
    """Q1 for change messages that are not parsed yet."""
    return rejected(parse_messages(messages, row, key, value, message_key))


def valid_changes(changes: DataFrame) -> DataFrame:
    return changes.filter(F.col("_reason").isNull()).drop("_reason")


def latest_per_key(changes: DataFrame, key: list[str]) -> DataFrame:
    """The change with the highest (lsn, seq) per key, as one combinable
    aggregate."""
    best = F.max(F.struct(F.col("lsn"), F.col("seq"), F.col("op"), F.col("after")))
    return (changes.groupBy(*key).agg(best.alias("_m"))
            .select(*key, F.col("_m.lsn").alias("lsn"), F.col("_m.seq").alias("seq"),
                    F.col("_m.op").alias("op"), F.col("_m.after").alias("after")))


def _rows(latest: DataFrame, key: list[str], keep_lsn: bool,
          keep_tombstones: bool = False) -> DataFrame:
    row_cols = [F.col(f"after.{f}").alias(f) for f in
                latest.schema["after"].dataType.fieldNames() if f not in key]
    extra = [F.col("lsn").alias("_lsn")] if keep_lsn else []
    if keep_tombstones:
        return latest.select(*key, *row_cols, *extra, (F.col("op") == "d").alias("_deleted"))
    return latest.filter(F.col("op") != "d").select(*key, *row_cols, *extra)


def state_at(changes: DataFrame, key: list[str], lsn: int | Column | None = None,
             keep_lsn: bool = False, keep_tombstones: bool = False) -> DataFrame:
    """Table contents as of ``lsn`` (inclusive; ``None`` = latest):
    latest change per key, deletes removed (or kept as ``_deleted`` rows),
    the after image flattened."""
    ch = changes if lsn is None else changes.filter(F.col("lsn") <= lsn)
    return _rows(latest_per_key(ch, key), key, keep_lsn, keep_tombstones)


def changes_since(changes: DataFrame, lsn: int | Column) -> DataFrame:
    """Changes strictly after ``lsn`` (replay from any point)."""
    return changes.filter(F.col("lsn") > lsn)


def _table_as_changes(table: DataFrame, key: list[str], row_fields: list[str],
                      before_type, table_lsn: str | None) -> DataFrame:
    lsn_col = (F.col(table_lsn) if table_lsn and table_lsn in table.columns
               else F.lit(-1)).cast("long")
    deleted = "_deleted" in table.columns
    op = F.when(F.col("_deleted"), F.lit("d")).otherwise(F.lit("r")) if deleted else F.lit("r")
    image = F.struct(*[F.col(f) for f in row_fields])
    return table.select(
        *key, op.alias("op"), F.lit(None).cast(before_type).alias("before"),
        (F.when(~F.col("_deleted"), image) if deleted else image).alias("after"),
        lsn_col.alias("lsn"), F.lit(None).cast("long").alias("tx_id"),
        F.lit(None).cast("string").alias("table"), F.lit(-1).cast("long").alias("seq"))


def apply_changes(table: DataFrame, changes: DataFrame, key: list[str],
                  table_lsn: str | None = "_lsn", applied_through: int | None = None,
                  keep_tombstones: bool = False) -> DataFrame:
    """Merge a batch of changes into a keyed table.

    The table's rows enter as snapshot changes at their own ``_lsn`` (or at
    -1 when the table has none); tombstone rows (``_deleted``) enter as
    deletes.  Rows and changes are reduced with the latest-per-key
    aggregate, so upserts and deletes resolve in one shuffle on the key.
    Re-applying the same changes is a no-op, and a change older than what the
    table holds for its key never wins.  A deleted key is protected from a
    stale re-insert only if the table keeps its tombstone
    (``keep_tombstones``) or the caller passes ``applied_through``, the LSN
    the table is known to be current to.

    A primary key is not NULL: table rows and changes without one are left
    out.  Rows of keys that the batch does not touch pass through as they are.

    Plan: the table is split by the batch's keys with a semi and an anti join;
    neither carries a hint, so the rows do not depend on how Spark runs them
    (by size it broadcasts the keys, and the untouched rows are not shuffled).
    """
    row_fields = list(changes.schema["after"].dataType.fieldNames())
    before_type = changes.schema["before"].dataType
    ch = changes.select(*key, "op", "before", "after", "lsn", "tx_id", "table", "seq")
    if applied_through is not None:
        ch = ch.filter(F.col("lsn") > applied_through)
    keep_lsn = table_lsn is not None

    def merge(rows: DataFrame) -> DataFrame:
        as_changes = _table_as_changes(rows, key, row_fields, before_type, table_lsn)
        return _rows(latest_per_key(as_changes.unionByName(ch), key), key,
                     keep_lsn=keep_lsn, keep_tombstones=keep_tombstones)

    present = " AND ".join(f"`{k}` IS NOT NULL" for k in key)
    ch, table = ch.filter(present), table.filter(present)
    touched = ch.select(*key).distinct()
    merged = merge(table.join(touched, on=key, how="left_semi"))
    rest = table.join(touched, on=key, how="left_anti")
    deleted = "_deleted" in rest.columns
    if deleted and not keep_tombstones:
        rest = rest.filter(~F.col("_deleted"))
    cols = [F.col(k) for k in key] + [F.col(f) for f in row_fields if f not in key]
    if keep_lsn:
        cols.append((F.col(table_lsn) if table_lsn in rest.columns else F.lit(-1))
                    .cast("long").alias("_lsn"))
    if keep_tombstones:
        cols.append((F.col("_deleted") if deleted else F.lit(False)).alias("_deleted"))
    return rest.select(*cols).unionByName(merged)


def merge_latest(table: DataFrame, latest: DataFrame, key: list[str]) -> DataFrame:
    """A keyed table with ``_lsn`` and tombstones (``_deleted``), one row a key, merged
    with changes that are one row a key too (``latest_per_key``): the rows that
    ``apply_changes`` gives, from one join.  The later of the two wins by the order
    of ``latest_per_key``."""
    row = latest.schema["after"].dataType
    place = ["lsn", "seq", "op", "after"]
    held = _table_as_changes(table, key, row.fieldNames(), row, "_lsn").select(*key, F.struct(*place).alias("_held"))
    come = latest.select(*key, F.struct(*place).alias("_come"))
    best = F.when(F.col("_held").isNull() | (F.col("_come") > F.col("_held")), F.col("_come")).otherwise(F.col("_held"))
    one = held.join(come, key, "full_outer").select(*key, best.alias("_m")).select(*key, *[F.col(f"_m.{c}").alias(c) for c in place])
    return _rows(one, key, keep_lsn=True, keep_tombstones=True)


def audit(changes: DataFrame, key: list[str]) -> DataFrame:
    """One row per changed column of each update, from the before/after
    images (no window over the key).  Updates and deletes whose before image
    is missing give a single row with ``column_name`` NULL."""
    fields = [f for f in changes.schema["after"].dataType.fieldNames() if f not in key]
    diffs = F.array(*[
        F.when(~F.col("before")[f].eqNullSafe(F.col("after")[f]),
               F.struct(F.lit(f).alias("column_name"),
                        F.col("before")[f].cast("string").alias("old_value"),
                        F.col("after")[f].cast("string").alias("new_value")))
        for f in fields])
    unknown = F.array(F.struct(F.lit(None).cast("string").alias("column_name"),
                               F.lit(None).cast("string").alias("old_value"),
                               F.lit(None).cast("string").alias("new_value")))
    per_row = (F.when(F.col("before").isNull(), unknown)
               .otherwise(F.filter(diffs, lambda x: x.isNotNull())))
    return (changes.filter(F.col("op").isin("u", "d"))
            .select(*key, "lsn", "op", F.explode(per_row).alias("_d"))
            .select(*key, "lsn", "op", "_d.column_name", "_d.old_value", "_d.new_value"))
