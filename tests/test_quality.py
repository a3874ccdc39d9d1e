"""Level-1 metrics/alerts (threshold boundaries) and the expectation suite."""

from pyspark.sql import functions as F

from conftest import SF01
from ledgerlake.operators import expectations as EX
from ledgerlake.operators import metrics as ME
from ledgerlake.plans.registry import silver_df


def _metrics_row(spark, **rates):
    cols = ["records", "null_rate", "bad_amount_rate", "invalid_cat_rate", "pass_rate", "fraud_rate"]
    vals = [1000, rates.get("null_rate", 0.0), rates.get("bad_amount_rate", 0.0),
            rates.get("invalid_cat_rate", 0.0), 1.0, rates.get("fraud_rate", 0.02)]
    return spark.createDataFrame([tuple(vals)], ",".join(
        f"{c} {'bigint' if c == 'records' else 'double'}" for c in cols))


def _rules(spark, **rates):
    return sorted(r.rule for r in ME.alerts(_metrics_row(spark, **rates)).collect())


def test_rates_rounded_before_compare(spark):
    # 0.00104 rounds to 0.0010 -> no alert; 0.00106 -> 0.0011 -> alert
    df = spark.createDataFrame(
        [(i < 104, ) for i in range(100000)], "dq_invalid_category boolean")
    df = df.select("*", F.lit(False).alias("dq_missing_required"),
                   F.lit(False).alias("dq_amount_out_of_range"),
                   F.lit(True).alias("dq_passed"), F.lit(False).alias("_is_fraud_label"))
    m = ME.batch_metrics(df).first()
    assert m.invalid_cat_rate == 0.001
    assert "L3_invalid_cat_rate" not in [r.rule for r in ME.alerts(ME.batch_metrics(df)).collect()]


def test_threshold_boundaries(spark):
    assert _rules(spark, null_rate=0.01) == []
    assert _rules(spark, null_rate=0.0101) == ["L1_null_rate"]
    assert _rules(spark, bad_amount_rate=0.0101) == ["L2_bad_amount_rate"]
    assert _rules(spark, invalid_cat_rate=0.001) == []
    assert _rules(spark, invalid_cat_rate=0.0011) == ["L3_invalid_cat_rate"]
    assert _rules(spark, fraud_rate=0.0001) == []
    assert _rules(spark, fraud_rate=0.0) == ["L4_fraud_rate"]
    assert _rules(spark, fraud_rate=0.1) == []
    assert _rules(spark, fraud_rate=0.1001) == ["L4_fraud_rate"]


def test_whole_table_as_one_batch_sf001(spark):
    s = silver_df(spark, SF01)
    rows = ME.alerts(ME.batch_metrics(s)).collect()
    assert [r.rule for r in rows] == ["L3_invalid_cat_rate"]
    assert rows[0].observed == 0.0016


def test_empty_batch_is_skipped(spark):
    s = silver_df(spark, SF01).limit(0)
    assert ME.batch_metrics(s).count() == 0


def test_suite_outcome_sf001(spark):
    res = EX.run_expectations(silver_df(spark, SF01), run_id="r1")
    failed = sorted(r.rule_id for r in res.collect() if not r.success)
    assert failed == ["E1", "E12", "E5", "E8", "E9"]
    s = EX.summarise(res, batch_id="b").first()
    assert (s.expectations_run, s.expectations_passed, s.expectations_failed) == (15, 10, 5)
    assert s.pass_rate == 0.6667 and s.status == "FAILED" and s.success is False
    gates = sorted(r.gate for r in EX.gates(EX.summarise(res)).collect())
    assert gates == ["G1_run_failed", "G2_pass_rate"]


def test_suite_passes_on_clean_rows(spark):
    clean = silver_df(spark, SF01).filter("dq_passed = true")
    res = {r.rule_id: r for r in EX.run_expectations(clean).collect()}
    assert res["E12"].success and res["E8"].success and res["E5"].success
    assert abs(res["E12"].observed_value - 49.65) < 0.01


def test_uniqueness_counts_every_member(spark):
    df = spark.createDataFrame([("a",), ("a",), ("a",), ("b",), (None,)], "event_id string")
    r = EX.run_expectations(df, [EX.Rule("E7", "unique", "event_id")]).first()
    assert (r.nonnull_count, r.unexpected_count, r.success) == (4, 3, False)
    u = EX.uniqueness(df.withColumn("g", F.lit(1)), "event_id", ["g"]).first()
    assert u.uq_excess_rows == 2


def test_mostly_threshold(spark):
    rows = [("grocery",)] * 999 + [("bad",)]
    df = spark.createDataFrame(rows, "merchant_category string")
    ok = EX.Rule("E9", "in_set", "merchant_category", {"values": ["grocery"]}, mostly=0.999)
    strict = EX.Rule("G6c", "in_set", "merchant_category", {"values": ["grocery"]})
    res = {r.rule_id: r.success for r in EX.run_expectations(df, [ok, strict]).collect()}
    assert res == {"E9": True, "G6c": False}


def test_run_log_insert_if_absent(spark, scratch):
    res = EX.run_expectations(silver_df(spark, SF01), run_id="run-1")
    rows = EX.run_log_rows(EX.summarise(res))
    first = EX.append_run_log(spark, rows, scratch).count()
    second = EX.append_run_log(spark, rows, scratch).count()
    assert (first, second) == (1, 0)
    log = spark.read.parquet(scratch).first()
    assert log.total_records == 10000 and log.passed_records == 9927 and log.failed_records == 73


def test_suite_is_two_aggregates(spark):
    res = EX.run_expectations(silver_df(spark, SF01))
    plan = res._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_inputs_do_not_raise_under_ansi(spark):
    empty = silver_df(spark, SF01).limit(0)
    r = EX.null_rate(empty, ["event_id"]).first()
    assert r.records == 0 and r.null_rate is None
    # the suite still runs: 15 results, a mean of nothing fails, both gates fire
    res = EX.run_expectations(empty)
    assert res.count() == 15 and {r.rule_id for r in res.filter("NOT success").collect()} == {
        x.rule_id for x in EX.SUITE if x.expectation == "mean_between"}
    summary = EX.summarise(res)
    assert summary.first().status == "FAILED" and EX.run_log_rows(summary).count() == 1
    assert "G1_run_failed" in {r.gate for r in EX.gates(summary).collect()}
    assert ME.batch_metrics(empty).count() == 0


def test_pass_rate_rounds_half_even(spark):
    rows = [("r", i == 0, 10, 5) for i in range(32)]          # 1 of 32 -> 0.03125
    res = spark.createDataFrame(rows, "run_id string, success boolean, element_count long, "
                                      "passed_records long")
    assert EX.summarise(res).first().pass_rate == 0.0312
