"""Quarantine (dead-letter) operators Q1-Q5.

Rows that cannot be decoded (Q1) or break the contract (Q2) are kept with
their original bytes, Kafka partition + offset, the reason and the list of
(field, rule) violations, partitioned by detection date (Q3).  Replay (Q4)
re-decodes them with the current registry or a fix, once (``replay``) or as
numbered attempts with a ledger (``replay_attempt``); retention (Q5) drops
whole date partitions.  Rows that decode but fail a quality flag are *not*
quarantined: they stay in silver with their flags.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions import wire
from ledgerlake.schemas import QUARANTINE_RETENTION_DAYS
from ledgerlake.sources import files

QUARANTINE_KEY = ["kafka_partition", "kafka_offset"]


def violation_summary(violations: Column) -> Column:
    """``field:rule`` pairs joined with ``;`` (NULL when there are none)."""
    pairs = F.transform(violations, lambda v: F.concat_ws(":", v["field"], v["rule"]))
    return F.when(F.size(violations) > 0, F.array_join(pairs, ";"))


def quarantined(decoded: DataFrame, raw: str = "raw_bytes",
                detected_at: Column | None = None) -> DataFrame:
    """Q1 + Q2: the rejected side of ``wire.decode`` in the quarantine shape."""
    ts = detected_at if detected_at is not None else F.current_timestamp()
    return (decoded.filter(F.col("_reason").isNotNull())
            .select(F.col(raw).alias("raw_value"), "kafka_timestamp", "kafka_partition", "kafka_offset",
                    F.col("_reason").alias("reason"),
                    F.col("_violations").alias("violations"),
                    violation_summary(F.coalesce(F.col("_violations"),
                                                 F.array().cast("array<struct<field:string,rule:string>>")))
                    .alias("violation_summary"),
                    ts.alias("detected_at"))
            .withColumn("detected_date", F.to_date("detected_at")))


def write_quarantine(q: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Q3: append by ``detected_date``.  With ``batch_id`` the batch owns the
    folder ``_batch_id=N``, which a retry overwrites whole: also one that runs
    after midnight and detects on another date."""
    if batch_id is None:
        q.write.mode("append").partitionBy("detected_date").parquet(path)
    else:
        q.write.mode("overwrite").partitionBy("detected_date").parquet(f"{path}/_batch_id={int(batch_id)}")


def replay(quarantine: DataFrame, schemas: DataFrame | dict,
           already_accepted: DataFrame | None = None,
           fix: Callable[[Column], Column] | None = None) -> DataFrame:
    """Q4: re-decode quarantined bytes (after an optional ``fix`` of the raw
    value) with the current registry.  Returns ``wire.decode`` output, so the
    caller routes it the same way; rows whose (partition, offset) was already
    accepted are removed with a left-anti join on the key."""
    raw = F.col("raw_value")
    env = quarantine.select(
        (F.col("kafka_timestamp") if "kafka_timestamp" in quarantine.columns
         else F.lit(None).cast("timestamp")).alias("kafka_timestamp"),
        "kafka_partition", "kafka_offset",
        (fix(raw) if fix else raw).alias("raw_bytes"))
    if already_accepted is not None:
        env = env.join(already_accepted.select(*QUARANTINE_KEY).distinct(),
                       on=QUARANTINE_KEY, how="left_anti")
    return wire.decode(env, schemas)


# ---- Q4 with a ledger -----------------------------------------------------------
MESSAGE_KEY = ["kafka_topic", "kafka_partition", "kafka_offset"]
ACCEPTED, FAILED, POISON = "accepted", "failed", "poison"
MAX_ATTEMPTS = 3
DEFAULT_TOPIC = "transactions.raw"


@dataclass(frozen=True)
class ReplayPaths:
    """``accepted``: decoded rows; ``emitted``: their messages, to be produced again;
    ``ledger``: a row for each message and attempt.  Each attempt owns a folder."""
    accepted: str
    emitted: str
    ledger: str


def attempts(spark: SparkSession, ledger: str) -> list[int]:
    """Attempts whose ledger rows are complete."""
    names = [n for n in files.list_names(spark, ledger) if n.startswith("_attempt=")]
    return sorted(int(n.split("=")[1]) for n in names if "_SUCCESS" in files.list_names(spark, f"{ledger}/{n}"))


def ledger_state(spark: SparkSession, ledger: str, before: int | None = None) -> DataFrame:
    """(message key, state, attempts, reason): each message's last state, as one
    combinable aggregate over the attempts before ``before``."""
    known = [n for n in attempts(spark, ledger) if before is None or n < before]
    kind = "kafka_topic string, kafka_partition int, kafka_offset long, attempt long, attempts long, state string, reason string"
    if not known:
        return spark.createDataFrame([], kind).drop("attempt")
    rows = spark.read.schema(kind).parquet(*[f"{ledger}/_attempt={n}" for n in known])
    last = F.max(F.struct("attempts", "attempt", "state", "reason")).alias("s")
    return rows.groupBy(*MESSAGE_KEY).agg(last).select(*MESSAGE_KEY, "s.attempts", "s.state", "s.reason")


def replay_attempt(quarantine: DataFrame, attempt: int, paths: ReplayPaths, schemas: DataFrame | dict,
                   fix: Callable[[Column], Column] | None = None, max_attempts: int = MAX_ATTEMPTS,
                   topic: str = DEFAULT_TOPIC) -> bool:
    """Q4: one replay of what is still open: neither accepted before nor given up
    after ``max_attempts`` failures (``poison``).

    Messages are named by (topic, partition, offset); one that was quarantined
    more than once is tried once.  The ledger's rows are written last, so an attempt
    that dies is open still, and its retry overwrites its own folders; a complete
    attempt is not run again.  Returns whether it ran."""
    spark, attempt = quarantine.sparkSession, int(attempt)
    if attempt in attempts(spark, paths.ledger):
        return False
    named = quarantine if "kafka_topic" in quarantine.columns else quarantine.withColumn("kafka_topic", F.lit(topic))
    time = F.col("kafka_timestamp") if "kafka_timestamp" in named.columns else F.lit(None).cast("timestamp")
    raw = F.col("raw_value")
    # one row a message, combined before the shuffle (a message may have been rejected often)
    once = (named.select(*MESSAGE_KEY, time.alias("kafka_timestamp"), (fix(raw) if fix else raw).alias("raw_bytes"))
            .groupBy(*MESSAGE_KEY).agg(F.max(F.struct("kafka_timestamp", "raw_bytes")).alias("m"))
            .select(*MESSAGE_KEY, "m.kafka_timestamp", "m.raw_bytes"))
    state = ledger_state(spark, paths.ledger, attempt)
    on = [once[k].eqNullSafe(state[k]) for k in MESSAGE_KEY]
    todo = once.join(state, on, "left").where(F.coalesce(F.col("state"), F.lit(FAILED)) == FAILED).select(
        *[once[k] for k in MESSAGE_KEY], "kafka_timestamp", "raw_bytes", F.coalesce("attempts", F.lit(0)).cast("long").alias("tried"))
    folder = f"_attempt={attempt}"
    tried = wire.decode(todo, schemas).persist()
    try:
        good = tried.filter(F.col("_reason").isNull())
        good.drop("_reason", "_violations", "raw_bytes", "tried").write.mode("overwrite").parquet(f"{paths.accepted}/{folder}")
        (good.select(F.col("event_id").cast("binary").alias("key"), F.col("raw_bytes").alias("value"), F.col("kafka_topic").alias("topic"),
                     *MESSAGE_KEY[1:]).write.mode("overwrite").parquet(f"{paths.emitted}/{folder}"))
        n = F.col("tried") + 1
        (tried.select(*MESSAGE_KEY, F.lit(attempt).cast("long").alias("attempt"), n.alias("attempts"),
                      F.when(F.col("_reason").isNull(), ACCEPTED).when(n >= max_attempts, POISON).otherwise(FAILED).alias("state"),
                      F.col("_reason").alias("reason"))
         .write.mode("overwrite").parquet(f"{paths.ledger}/{folder}"))
    finally:
        tried.unpersist()
    return True


def replayed(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Rows of the complete attempts below ``path`` (accepted rows or messages)."""
    return spark.read.parquet(*[f"{path}/_attempt={n}" for n in attempts(spark, ledger)])


def expire(quarantine: DataFrame, today: str | Column | None = None,
           days: int = QUARANTINE_RETENTION_DAYS) -> DataFrame:
    """Q5: rows still inside the retention window (a partition filter)."""
    t = (F.current_date() if today is None
         else F.lit(today).cast("date") if isinstance(today, str) else today)
    return quarantine.filter(F.col("detected_date") >= F.date_sub(t, days))


def drop_expired_partitions(spark: SparkSession, path: str, today: str,
                            days: int = QUARANTINE_RETENTION_DAYS) -> list[str]:
    """Q5 on storage: delete ``detected_date=`` folders older than the window,
    also those inside ``_batch_id=`` folders.  Only folder names are listed
    (metadata); no data is read."""
    import datetime as dt
    cutoff = dt.date.fromisoformat(today) - dt.timedelta(days=days)
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dropped = []
    if not fs.exists(hpath):
        return dropped
    folders = [st for st in fs.listStatus(hpath) if st.isDirectory()]
    for st in list(folders):
        if st.getPath().getName().startswith("_batch_id="):
            folders += [x for x in fs.listStatus(st.getPath()) if x.isDirectory()]
    for st in folders:
        name = st.getPath().getName()
        if not name.startswith("detected_date="):
            continue
        try:
            d = dt.date.fromisoformat(name.split("=", 1)[1])
        except ValueError:
            continue
        if d < cutoff:
            fs.delete(st.getPath(), True)
            dropped.append(name)
    return dropped
