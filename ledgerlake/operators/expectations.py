"""Level-2 quality: a declarative expectation suite evaluated in two passes.

E1-E15 (and the contract rules G4-G6) are rows of a rule list.  Every
null / range / set / regex / mean rule compiles into ONE aggregate over the
table (A4, A6, A7); uniqueness (A5) is the second job: a grouped count on the
key (partial aggregation first, so a key repeated across a third of the table
is pre-counted per task before the shuffle), then a final aggregate.  Result
rows are ``(run_id, rule_id, expectation, column_name, success, element_count,
nonnull_count, unexpected_count, unexpected_percent, observed_value)``.

Semantics: value rules ignore NULLs (nulls belong to the not-null rules);
a value rule succeeds iff the passing share of non-null values is at least
``mostly`` (no non-null values -> success); a mean rule succeeds iff the mean
lies in [min, max] (mean of nothing, or NaN -> failure).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.uniqueness import uniqueness_by_fingerprint
from ledgerlake.schemas import (AMOUNT_MAX, AMOUNT_MIN, COUNTRY_CODE_PATTERN,
                                MAX_REQUIRED_NULL_RATE, MIN_PASS_RATE, UUID_V4_PATTERN,
                                VALID_CATEGORIES, VALID_CURRENCIES)


@dataclass(frozen=True)
class Rule:
    rule_id: str
    expectation: str          # not_null | unique | between | in_set | regex | mean_between
    column: str
    params: dict = field(default_factory=dict)
    mostly: float = 1.0


# The 15-expectation suite run over the whole silver table.
SUITE = [
    Rule("E1", "not_null", "event_id"),
    Rule("E2", "not_null", "event_timestamp"),
    Rule("E3", "not_null", "user_id"),
    Rule("E4", "not_null", "merchant_id"),
    Rule("E5", "not_null", "amount"),
    Rule("E6", "not_null", "is_online"),
    Rule("E7", "unique", "event_id"),
    Rule("E8", "between", "amount", {"min": AMOUNT_MIN, "max": AMOUNT_MAX}),
    Rule("E9", "in_set", "merchant_category", {"values": VALID_CATEGORIES}, mostly=0.999),
    Rule("E10", "regex", "country_code", {"pattern": COUNTRY_CODE_PATTERN}, mostly=0.99),
    Rule("E11", "in_set", "currency", {"values": VALID_CURRENCIES}),
    Rule("E12", "mean_between", "amount", {"min": 10.0, "max": 500.0}),
    Rule("E13", "mean_between", "_is_fraud_label", {"min": 0.01, "max": 0.05}),
    Rule("E14", "mean_between", "dq_passed", {"min": 0.99, "max": 1.0}),
    Rule("E15", "mean_between", "is_high_risk_country", {"min": 0.05, "max": 0.15}),
]

# Contract rules (G4-G6): UUID v4 keys, alpha-2 countries, and E7-E9 strict.
CONTRACT = [
    Rule("G4", "regex", "event_id", {"pattern": UUID_V4_PATTERN}),
    Rule("G5", "regex", "country_code", {"pattern": COUNTRY_CODE_PATTERN}),
    Rule("G6a", "unique", "event_id"),
    Rule("G6b", "between", "amount", {"min": AMOUNT_MIN, "max": AMOUNT_MAX}),
    Rule("G6c", "in_set", "merchant_category", {"values": VALID_CATEGORIES}),
]


def _unexpected(rule: Rule) -> Column | None:
    c = F.col(rule.column)
    p = rule.params
    if rule.expectation == "not_null":
        return c.isNull()
    if rule.expectation == "between":
        return c.isNotNull() & ((c < p["min"]) | (c > p["max"]))
    if rule.expectation == "in_set":
        return c.isNotNull() & ~c.isin(*p["values"])
    if rule.expectation == "regex":
        return c.isNotNull() & ~c.rlike(p["pattern"])
    return None


def _agg_columns(rules: list[Rule]) -> list[Column]:
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, r in enumerate(rules):
        if r.expectation == "unique":
            continue
        if r.expectation == "mean_between":
            aggs.append(F.avg(F.col(r.column).cast("double")).alias(f"m{i}"))
            aggs.append(F.count(r.column).alias(f"nn{i}"))
            continue
        aggs.append(F.count(r.column).alias(f"nn{i}"))
        aggs.append(F.count_if(_unexpected(r)).alias(f"u{i}"))
    return aggs


def _result_struct(i: int, r: Rule) -> Column:
    n = F.col("n")
    if r.expectation == "mean_between":
        nonnull = F.col(f"nn{i}")
        unexpected = F.lit(None).cast("long")
        pct = F.lit(None).cast("double")
        mean = F.col(f"m{i}")
        success = F.coalesce(
            (mean >= r.params["min"]) & (mean <= r.params["max"]), F.lit(False))
        # reported to 9 decimals; success is decided on the exact mean
        observed = F.round(mean, 9)
    else:
        if r.expectation == "unique":
            nonnull, unexpected = F.col("uq_nonnull"), F.col("uq_dup_rows")
        else:
            nonnull, unexpected = F.col(f"nn{i}"), F.col(f"u{i}")
        base = n if r.expectation == "not_null" else nonnull
        pct = F.when(base > 0, unexpected.cast("double") * 100.0 / base.cast("double"))
        observed = F.lit(None).cast("double")
        success = F.when(base == 0, F.lit(True)).otherwise(
            (base - unexpected).cast("double") / base.cast("double") >= F.lit(r.mostly))
    return F.struct(
        F.lit(r.rule_id).alias("rule_id"),
        F.lit(r.expectation).alias("expectation"),
        F.lit(r.column).alias("column_name"),
        success.alias("success"),
        n.alias("element_count"),
        nonnull.cast("long").alias("nonnull_count"),
        unexpected.cast("long").alias("unexpected_count"),
        pct.alias("unexpected_percent"),
        observed.alias("observed_value"),
    )


def uniqueness(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """A5 per group: rows whose key occurs more than once (every member of a
    duplicate group, ``dup_rows``) and the excess over distinct (``excess``).
    NULL keys are ignored."""
    counts = (df.filter(F.col(column).isNotNull())
              .groupBy(*by, column).agg(F.count(F.lit(1)).alias("k")))
    return counts.groupBy(*by).agg(
        F.sum("k").alias("uq_nonnull"),
        F.sum(F.when(F.col("k") > 1, F.col("k")).otherwise(0)).alias("uq_dup_rows"),
        F.sum(F.col("k") - 1).alias("uq_excess_rows"))


def run_expectations(df: DataFrame, rules: list[Rule] | None = None,
                     run_id: str | Column = "run", by: str | list[str] | None = None,
                     by_fingerprint: bool = False) -> DataFrame:
    """Evaluate ``rules`` over ``df`` -> one result row per rule (per group).

    ``by`` evaluates the suite per group (e.g. per ``event_date``) in the same
    two jobs; ``run_id`` may be a literal or a column expression over ``by``.
    Each row also carries ``passed_records`` (rows with dq_passed = true in the
    run) when the input has a ``dq_passed`` column, for the run log.  Without
    ``by`` there is one run over everything, also over an empty table: its
    rules are evaluated on no rows (a mean of nothing fails).  ``by_fingerprint``
    finds repeated keys without shuffling the others (``uniqueness``; two more
    passes over the key, worth it for a stored table of many rows).
    """
    rules = list(SUITE if rules is None else rules)
    keys = [by] if isinstance(by, str) else list(by or [])
    aggs = _agg_columns(rules)
    if "dq_passed" in df.columns:
        aggs.append(F.count_if(F.col("dq_passed") == F.lit(True)).alias("passed_records"))
    else:
        aggs.append(F.lit(None).cast("long").alias("passed_records"))
    main = df.groupBy(*keys).agg(*aggs)
    uniq_cols = sorted({r.column for r in rules if r.expectation == "unique"})
    if len(uniq_cols) > 1:
        raise ValueError("one uniqueness key per suite")
    if uniq_cols:
        # Both sides hold one row per group: stack them and fold with max
        # (a tiny aggregate, no join).
        u = (uniqueness_by_fingerprint if by_fingerprint else uniqueness)(df, uniq_cols[0], keys)
        vals = [c for c in main.columns if c not in keys] + \
               [c for c in u.columns if c not in keys]
        main = (main.unionByName(u, allowMissingColumns=True)
                .groupBy(*keys).agg(*[F.max(c).alias(c) for c in vals])
                .fillna(0, subset=["uq_nonnull", "uq_dup_rows", "uq_excess_rows"]))
    rid = F.lit(run_id) if isinstance(run_id, str) else run_id
    out = main.select(*keys, rid.alias("run_id"),
                      F.inline(F.array(*[_result_struct(i, r) for i, r in enumerate(rules)])),
                      "passed_records")
    return out


def summarise(results: DataFrame, batch_id: str | Column | None = None,
              run_timestamp: Column | None = None) -> DataFrame:
    """A8 + G1: one summary row per run; with ``run_timestamp`` (such as
    ``F.current_timestamp()``) it carries the time of the run.

    pass_rate = round-half-even(success percent / 100, 4); status PASSED iff every
    rule succeeded.
    """
    bid = (F.lit(batch_id) if isinstance(batch_id, str)
           else batch_id if batch_id is not None else F.col("run_id"))
    run = F.count(F.lit(1))
    passed = F.count_if(F.col("success"))
    return (results.groupBy("run_id").agg(
                run.cast("int").alias("expectations_run"),
                passed.cast("int").alias("expectations_passed"),
                (run - passed).cast("int").alias("expectations_failed"),
                # half-even, as the upstream summary rounds with Python's round()
                F.bround(passed * 100.0 / run / 100.0, 4).alias("pass_rate"),
                F.bool_and("success").alias("success"),
                F.max("element_count").alias("total_records"),
                F.max("passed_records").alias("passed_records"))
            .withColumn("status", F.when(F.col("success"), "PASSED").otherwise("FAILED"))
            .withColumn("batch_id", bid)
            .withColumns({} if run_timestamp is None else {"run_timestamp": run_timestamp}))


def gates(summary: DataFrame, min_pass_rate: float = MIN_PASS_RATE) -> DataFrame:
    """G1/G2 alert rows: run failed, pass rate below ``min_pass_rate``."""
    g = F.array(
        F.struct(F.lit("G1_run_failed").alias("gate"), (~F.col("success")).alias("fires")),
        F.struct(F.lit("G2_pass_rate").alias("gate"),
                 (F.col("pass_rate") < min_pass_rate).alias("fires")))
    return (summary.select("run_id", "pass_rate", F.inline(g))
            .filter("fires").drop("fires"))


def null_rate(df: DataFrame, fields: list[str]) -> DataFrame:
    """Nulls over (rows x fields) on the required fields, one row."""
    nulls = sum((F.count_if(F.col(f).isNull()) for f in fields), F.lit(0))
    rows = F.count(F.lit(1))
    rate = F.try_divide(nulls.cast("double"), (rows * len(fields)).cast("double"))
    return df.agg(rows.alias("records"), nulls.cast("long").alias("null_cells"),
                  rate.alias("null_rate"),
                  (rate < MAX_REQUIRED_NULL_RATE).alias("within_contract"))


def run_log_rows(summary: DataFrame, run_timestamp: Column | None = None) -> DataFrame:
    """K6 row shape: ``dq_run_log``.  ``passed_records``/``failed_records``
    are true record counts (rows with dq_passed = true / not true); upstream
    stores expectation counts there, which we do not repeat."""
    ts = (run_timestamp if run_timestamp is not None
          else F.col("run_timestamp") if "run_timestamp" in summary.columns else F.current_timestamp())
    return summary.select(
        "run_id", ts.alias("run_timestamp"),
        F.col("batch_id").cast("string").alias("batch_id"),
        F.col("total_records").cast("long").alias("total_records"),
        F.col("passed_records").cast("long").alias("passed_records"),
        (F.col("total_records") - F.col("passed_records")).cast("long").alias("failed_records"),
        "pass_rate", "expectations_run", "expectations_failed", "status")


def write_summary_json(summary: DataFrame, path: str) -> None:
    """K5: validation summaries as JSON, one folder per run, with the run's
    time; a rerun of the same run_id, on whichever day, overwrites it."""
    if "run_timestamp" not in summary.columns:
        summary = summary.withColumn("run_timestamp", F.current_timestamp())
    (summary.withColumn("run_date", F.to_date("run_timestamp"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("run_id").json(path))


def append_run_log(spark, rows: DataFrame, path: str) -> DataFrame:
    """K6 + J1: append run-log rows whose ``run_id`` is not yet in the log
    (``ON CONFLICT (run_id) DO NOTHING``); returns the rows to append.

    The existing log's files are listed when the plan is analysed, and an
    append only adds committed files, so reading the key column of the same
    folder inside the job is safe.
    """
    from ledgerlake.operators.signals import append_absent
    from ledgerlake.sources.tables import path_exists
    existing = (spark.read.parquet(path).select("run_id") if path_exists(spark, path)
                else spark.createDataFrame([], "run_id string"))
    new = append_absent(rows, existing, "run_id")
    new.write.mode("append").parquet(path)
    return new


def append_run_log_jdbc(spark, rows: DataFrame, url: str, table: str,
                        properties: dict) -> DataFrame:
    """K6 into a relational table over JDBC (needs the database's JDBC driver
    on the classpath; not exercised in this repository's tests because no
    database may be started here).  Insert-if-absent on ``run_id`` is done in
    Spark before the append: only the key column of the table is read."""
    from ledgerlake.operators.signals import append_absent
    existing = spark.read.jdbc(url, f"(SELECT run_id FROM {table}) existing_runs",
                               properties=properties)
    new = append_absent(rows, existing, "run_id")
    new.write.jdbc(url, table, mode="append", properties=properties)
    return new


def passes_gate(summary: DataFrame, min_pass_rate: float = MIN_PASS_RATE) -> bool:
    """G2 as a gate for downstream jobs (e.g. retraining): every run in the
    summary has pass_rate >= ``min_pass_rate``.  One row reaches the driver."""
    r = summary.agg(F.min("pass_rate").alias("p")).first()
    return r is not None and r.p is not None and r.p >= min_pass_rate
