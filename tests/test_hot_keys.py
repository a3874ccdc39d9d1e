"""One key holding a third of all rows: results stay exact and the plans
pre-aggregate before shuffling (no single task receives the hot key's rows)."""

from pyspark.sql import functions as F

from ledgerlake.operators import cdc as CD
from ledgerlake.operators import expectations as EX
from ledgerlake.operators import signals as SG
from ledgerlake.sources.changes import ORDER_KEY, ORDER_ROW

N = 30_000


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _changes(spark):
    # key 0 receives every third change; LSN = row number
    return (spark.range(N)
            .select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("o_orderkey"),
                    F.col("id").alias("lsn"))
            .select("o_orderkey", F.lit("u").alias("op"),
                    F.lit(None).cast(ORDER_ROW).alias("before"),
                    F.struct(F.col("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"),
                             F.col("lsn").cast("string").alias("o_orderstatus"),
                             F.lit(1.0).alias("o_totalprice"),
                             F.lit(None).cast("date").alias("o_orderdate"),
                             F.lit("x").alias("o_orderpriority")).alias("after"),
                    "lsn", F.lit(None).cast("long").alias("tx_id"),
                    F.lit("orders").alias("table"), F.lit(0).cast("long").alias("seq"))
            .repartition(8))


def test_cdc_hot_key_latest_state(spark):
    state = CD.state_at(_changes(spark), ORDER_KEY)
    hot = state.filter("o_orderkey = 0").first()
    assert hot.o_orderstatus == str(N - 3)             # the last change of key 0 wins
    assert state.count() == 1 + (N - N // 3)
    assert "partial_max" in _plan(state)                # combined per task before the exchange


def test_uniqueness_hot_value(spark):
    df = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit("dup")).otherwise(F.col("id").cast("string"))
        .alias("event_id")).repartition(8)
    r = EX.run_expectations(df, [EX.Rule("E7", "unique", "event_id")]).first()
    assert r.unexpected_count == N // 3 and r.nonnull_count == N
    assert "partial_count" in _plan(EX.uniqueness(df.withColumn("g", F.lit(1)), "event_id", ["g"]))


def test_append_absent_hot_key(spark):
    new = spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v")).repartition(8)
    existing = spark.range(1, 10).select(F.col("id").alias("k"))
    out = SG.append_absent(new, existing, "k")
    # one row per key, existing keys removed, the hot key kept once
    assert out.count() == out.select("k").distinct().count()
    assert out.filter("k = 0").count() == 1
    assert out.filter("k BETWEEN 1 AND 9").count() == 0


def test_append_absent_keeps_the_first_and_ignores_the_plan(spark):
    new = spark.range(0, 5000).select((F.col("id") % 4000).alias("k"), F.col("id").alias("v"))
    existing = spark.range(2500, 100000).select(F.col("id").alias("k"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = []
    for limit in ("10485760", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        rows.append(sorted(SG.append_absent(new, existing, "k", ["v"]).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert rows[0] == rows[1] and [tuple(r) for r in rows[0]] == [(k, k) for k in range(2500)]

