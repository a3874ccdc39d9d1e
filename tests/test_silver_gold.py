"""Silver flags (three-valued truth table), fixture counts, gold summary."""

import math

from pyspark.sql import functions as F

from conftest import SF001, SF01
from ledgerlake.operators import gold as G
from ledgerlake.operators.silver import to_silver
from ledgerlake.plans.registry import silver_df

TX_COLS = ("event_id string, event_timestamp timestamp, user_id string, "
           "merchant_category string, amount double")


def _flags(spark, rows):
    df = spark.createDataFrame(rows, TX_COLS).withColumn("country_code", F.lit("US"))
    out = to_silver(df, audit=False).orderBy("user_id").collect()
    return [(r.dq_invalid_category, r.dq_amount_out_of_range, r.dq_missing_required, r.dq_passed)
            for r in out]


def test_truth_table(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    nan = float("nan")
    rows = [
        ("a", t, "u1", "grocery", 1.0),
        ("b", t, "u2", None, 1.0),
        (None, t, "u3", None, 1.0),
        ("c", t, "u4", "x", None),
        ("d", t, "u5", "grocery", 0.01),
        ("e", t, "u6", "grocery", 50000.0),
        ("f", t, "u7", "grocery", nan),
        ("g", t, "u8", None, 60000.0),
    ]
    assert _flags(spark, rows) == [
        (False, False, False, True),
        (None, False, False, None),
        (None, False, True, False),
        (True, None, True, False),
        (False, False, False, True),
        (False, False, False, True),
        (False, True, False, False),
        (None, True, False, False),
    ]


def test_fixture_counts_sf001(spark):
    s = silver_df(spark, SF001)
    r = s.agg(
        F.count_if(F.col("dq_passed")).alias("t"),
        F.count_if(~F.col("dq_passed")).alias("f"),
        F.count_if(F.col("dq_passed").isNull()).alias("n"),
        F.count_if(F.col("dq_missing_required")).alias("missing"),
        F.count_if(F.col("dq_amount_out_of_range")).alias("oor"),
        F.count_if(F.col("dq_invalid_category")).alias("invalid"),
        F.count_if(F.col("is_online")).alias("online"),
    ).first()
    assert (r.t, r.f, r.n) == (994, 5, 1)
    assert (r.missing, r.oor, r.invalid, r.online) == (2, 2, 1, 611)


def test_gold_rows_and_types(spark):
    g = G.gold_summary(silver_df(spark, SF001))
    assert g.count() == 287
    assert dict(g.dtypes)["total_transactions"] == "bigint"
    assert dict(g.dtypes)["fraud_count"] == "bigint"
    assert g.columns[:2] == ["event_date", "merchant_category"]


def test_gold_sql_equals_dataframe(spark):
    s = silver_df(spark, SF01)
    a = G.gold_summary(s)
    b = G.gold_summary_sql(spark, s)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_gold_drops_null_and_false(spark):
    s = silver_df(spark, SF01)
    total = G.gold_summary(s).agg(F.sum("total_transactions")).first()[0]
    assert total == 9927


def test_gold_write_is_idempotent(spark, scratch):
    s = silver_df(spark, SF001)
    g = G.gold_summary(s)
    G.write_gold(g, scratch)
    G.write_gold(g, scratch)      # re-run must not duplicate
    back = spark.read.parquet(scratch)
    assert back.count() == 287


def test_plan_pushes_filter_and_prunes(spark):
    s = silver_df(spark, SF01)
    plan = G.gold_summary(s)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan
    assert "props" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_mean_amount_nan_fails_mean_rule(spark):
    from ledgerlake.operators.expectations import Rule, run_expectations
    df = spark.createDataFrame([(1.0,), (float("nan"),)], "amount double")
    r = run_expectations(df, [Rule("E12", "mean_between", "amount", {"min": 0.0, "max": 10.0})]).first()
    assert r.success is False
    assert math.isnan(r.observed_value)


import pytest  # noqa: E402

# FIXTURES.md section 2, expected results per scale factor.
FIXTURE_TABLE = {
    "/root/testdata/sf0.001": dict(t=994, f=5, n=1, miss=2, oor=2, inv=1, nncat=998, badcc=2,
                                   fraud=0.022, hr=0.09, online=611, gold=287),
    "/root/testdata/sf0.01": dict(t=9927, f=59, n=14, miss=22, oor=21, inv=16, nncat=9985, badcc=20,
                                  fraud=0.0201, hr=0.0898, online=6004, gold=300),
}


@pytest.mark.parametrize("sf_dir", sorted(FIXTURE_TABLE))
def test_fixture_table(spark, sf_dir):
    s = silver_df(spark, sf_dir)
    r = s.agg(F.count_if(F.col("dq_passed")).alias("t"), F.count_if(~F.col("dq_passed")).alias("f"),
              F.count_if(F.col("dq_passed").isNull()).alias("n"),
              F.count_if("dq_missing_required").alias("miss"),
              F.count_if("dq_amount_out_of_range").alias("oor"),
              F.count_if("dq_invalid_category").alias("inv"), F.count("merchant_category").alias("nncat"),
              F.count_if(~F.col("country_code").rlike("^[A-Z]{2}$")).alias("badcc"),
              F.round(F.avg(F.col("_is_fraud_label").cast("double")), 4).alias("fraud"),
              F.round(F.avg(F.col("is_high_risk_country").cast("double")), 4).alias("hr"),
              F.count_if("is_online").alias("online")).first().asDict()
    r["gold"] = G.gold_summary(s).count()
    assert r == FIXTURE_TABLE[sf_dir]


def test_gold_write_registers_its_partitions_and_rule_is_a_row(spark, scratch):
    gold = G.gold_summary(silver_df(spark, SF001))
    assert G.output_rule(gold).first().asDict() == {
        "run_id": "gold", "rule": "G3_column_count", "observed": 10, "success": True}
    assert not G.output_rule(gold.drop("fraud_count")).first().success
    days = [r[0] for r in gold.select("event_date").distinct().orderBy("event_date").limit(2).collect()]
    spark.sql("DROP TABLE IF EXISTS gold_test.fraud_summary")
    for day in days:                                     # the second write adds a partition
        G.write_gold(gold.filter(F.col("event_date") == F.lit(day)), scratch, table="gold_test.fraud_summary")
    found = spark.table("gold_test.fraud_summary")
    assert {r[0] for r in found.select("event_date").distinct().collect()} == set(days)
    spark.sql("DROP DATABASE gold_test CASCADE")
