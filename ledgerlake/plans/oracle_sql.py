"""Independent DuckDB SQL for every SQL-expressible registered query.

Adjustments for engine differences (measured, see SURVEY section 5):
* ``SUM(int)`` is HUGEINT in DuckDB -> cast to BIGINT; ``hour()`` is BIGINT
  -> cast to INTEGER.
* Spark rounds half-up on the shortest decimal text of a double; DuckDB
  rounds the binary value.  ``rnd(x, n)`` reproduces Spark's rule.
"""

from __future__ import annotations

from ledgerlake.operators.expectations import CONTRACT, SUITE
from ledgerlake.schemas import HIGH_RISK_COUNTRIES, VALID_CATEGORIES, VALID_CURRENCIES
from ledgerlake.sources.tables import transaction_select_sql


def rnd(x: str, n: int) -> str:
    return f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,15)), {n}) AS DOUBLE)"


def _lst(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


CATS = _lst(VALID_CATEGORIES)
RISK = _lst(HIGH_RISK_COUNTRIES)
CURS = _lst(VALID_CURRENCIES)

TX = transaction_select_sql("events")

SILVER_FLAGS = f"""
  CAST(event_timestamp AS DATE) AS event_date,
  CAST(hour(event_timestamp) AS INTEGER) AS event_hour,
  country_code IN ({RISK}) AS is_high_risk_country,
  NOT (merchant_category IN ({CATS})) AS dq_invalid_category,
  (amount < 0.01 OR amount > 50000.0) AS dq_amount_out_of_range,
  (event_id IS NULL OR user_id IS NULL OR amount IS NULL) AS dq_missing_required,
  NOT ((NOT (merchant_category IN ({CATS})))
       OR (amount < 0.01 OR amount > 50000.0)
       OR (event_id IS NULL OR user_id IS NULL OR amount IS NULL)) AS dq_passed"""

SILVER = f"""SELECT *, {SILVER_FLAGS}, '1.1.0' AS _pipeline_version FROM ({TX}) tx"""


def gold_from(source: str) -> str:
    return f"""
SELECT event_date, merchant_category,
  count(*) AS total_transactions,
  count(*) FILTER (_is_fraud_label) AS fraud_count,
  {rnd('100.0 * count(*) FILTER (_is_fraud_label)::DOUBLE / nullif(count(_is_fraud_label), 0)', 3)} AS fraud_rate_pct,
  {rnd('avg(amount)', 2)} AS avg_amount,
  {rnd('max(amount)', 2)} AS max_amount,
  {rnd('sum(amount)', 2)} AS total_amount,
  count(*) FILTER (is_online) AS online_count,
  count(*) FILTER (is_high_risk_country) AS high_risk_country_count
FROM ({source}) s WHERE dq_passed GROUP BY ALL"""


GOLD = gold_from(SILVER)
RANKING = f"""
SELECT merchant_category, n AS transactions, {rnd('v', 2)} AS volume, {rnd('100 * v / (sum(v) OVER ())', 3)} AS volume_pct,
  dense_rank() OVER (ORDER BY n DESC)::INTEGER AS place
FROM (SELECT merchant_category, count(*) AS n, sum(amount) AS v FROM ({SILVER}) s
      WHERE dq_passed AND merchant_category IS NOT NULL GROUP BY 1) x"""

ORACLE: dict[str, str] = {
    "transactions": TX,
    "silver": SILVER,
    "gold_summary": GOLD,
    "gold_summary_sql": GOLD,
    "category_ranking_sql": RANKING,
}


# -- level 1: batch metrics and alerts ----------------------------------------
def metrics_from(source: str, keys: str = "event_date") -> str:
    def rate(flag):
        return rnd(f"SUM(CASE WHEN {flag} THEN 1 ELSE 0 END) / COUNT(*)", 4)
    return f"""
SELECT {keys}, COUNT(*) AS records,
  {rate('dq_missing_required')} AS null_rate,
  {rate('dq_amount_out_of_range')} AS bad_amount_rate,
  {rate('dq_invalid_category')} AS invalid_cat_rate,
  {rate('dq_passed')} AS pass_rate,
  {rate('_is_fraud_label')} AS fraud_rate
FROM ({source}) s GROUP BY {keys}"""


METRICS = metrics_from(SILVER)

HOURLY = "event_date, event_hour"
ALERTS = f"""
WITH m AS ({metrics_from(SILVER, HOURLY)})
SELECT {HOURLY}, 'L1_null_rate' AS rule, 'critical' AS severity, null_rate AS observed, 0.01::DOUBLE AS threshold FROM m WHERE null_rate > 0.01
UNION ALL
SELECT {HOURLY}, 'L2_bad_amount_rate', 'critical', bad_amount_rate, 0.01::DOUBLE FROM m WHERE bad_amount_rate > 0.01
UNION ALL
SELECT {HOURLY}, 'L3_invalid_cat_rate', 'critical', invalid_cat_rate, 0.001::DOUBLE FROM m WHERE invalid_cat_rate > 0.001
UNION ALL
SELECT {HOURLY}, 'L4_fraud_rate', 'warning', fraud_rate, 0.1::DOUBLE FROM m WHERE fraud_rate > 0.1 OR fraud_rate = 0.0
UNION ALL
SELECT {HOURLY}, 'L5_batch_summary', 'info', records::DOUBLE, NULL FROM m"""


# -- level 2: expectation suite ---------------------------------------------------
def _rule_sql(r, source: str, key: str | None, run_id: str) -> str:
    """One SELECT per rule, written directly from the rule's meaning."""
    col = r.column
    p = r.params
    gsel = f"{key}, " if key else ""
    gby = f" GROUP BY {key}" if key else ""
    rid = run_id
    head = (f"SELECT {gsel}{rid} AS run_id, '{r.rule_id}' AS rule_id, "
            f"'{r.expectation}' AS expectation, '{col}' AS column_name")
    passed = "COUNT(*) FILTER (WHERE dq_passed = true) AS passed_records"
    if r.expectation == "mean_between":
        mean = f"AVG(CAST({col} AS DOUBLE))"
        return (f"{head}, COALESCE({mean} >= {p['min']} AND {mean} <= {p['max']}, false) AS success, "
                f"COUNT(*) AS element_count, COUNT({col}) AS nonnull_count, "
                f"CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS DOUBLE) AS unexpected_percent, "
                f"{rnd(mean, 9)} AS observed_value, {passed} FROM ({source}) s{gby}")
    if r.expectation == "unique":
        kc = f"{key}, " if key else ""
        # rows of duplicated keys, all members counted; NULL keys ignored
        return (f"SELECT {gsel}{rid} AS run_id, '{r.rule_id}' AS rule_id, '{r.expectation}' AS expectation, "
                f"'{col}' AS column_name, "
                f"CASE WHEN nn = 0 THEN true ELSE CAST(nn - dup AS DOUBLE) / CAST(nn AS DOUBLE) >= {r.mostly} END AS success, "
                f"n AS element_count, nn AS nonnull_count, dup AS unexpected_count, "
                f"CASE WHEN nn > 0 THEN CAST(dup AS DOUBLE) * CAST(100 AS DOUBLE) / CAST(nn AS DOUBLE) END AS unexpected_percent, "
                f"CAST(NULL AS DOUBLE) AS observed_value, passed_records FROM ("
                f"SELECT {gsel}COUNT(*) AS n, COUNT({col}) AS nn, "
                f"CAST(SUM(CASE WHEN {col} IS NOT NULL AND cnt > 1 THEN 1 ELSE 0 END) AS BIGINT) AS dup, "
                f"COUNT(*) FILTER (WHERE dq_passed = true) AS passed_records FROM ("
                f"SELECT *, COUNT(*) OVER (PARTITION BY {kc}{col}) AS cnt FROM ({source}) s0) s1{gby}) s2")
    if r.expectation == "not_null":
        bad, base = f"{col} IS NULL", "COUNT(*)"
    elif r.expectation == "between":
        bad, base = f"{col} IS NOT NULL AND ({col} < {p['min']} OR {col} > {p['max']})", f"COUNT({col})"
    elif r.expectation == "in_set":
        bad, base = f"{col} IS NOT NULL AND NOT ({col} IN ({_lst(p['values'])}))", f"COUNT({col})"
    elif r.expectation == "regex":
        bad, base = f"{col} IS NOT NULL AND NOT regexp_full_match({col}, '{p['pattern']}')", f"COUNT({col})"
    else:
        raise ValueError(r.expectation)
    u = f"COUNT(*) FILTER (WHERE {bad})"
    return (f"{head}, CASE WHEN {base} = 0 THEN true ELSE CAST({base} - {u} AS DOUBLE) / CAST({base} AS DOUBLE) >= {r.mostly} END AS success, "
            f"COUNT(*) AS element_count, COUNT({col}) AS nonnull_count, {u} AS unexpected_count, "
            f"CASE WHEN {base} > 0 THEN CAST({u} AS DOUBLE) * CAST(100 AS DOUBLE) / CAST({base} AS DOUBLE) END AS unexpected_percent, "
            f"CAST(NULL AS DOUBLE) AS observed_value, {passed} FROM ({source}) s{gby}")


def suite_sql(rules, source: str, key: str | None = None, run_id: str = "'run'") -> str:
    return "\nUNION ALL\n".join(_rule_sql(r, source, key, run_id) for r in rules)


def summary_from(results: str, batch_id: str = "run_id") -> str:
    return f"""
SELECT run_id,
  CAST(COUNT(*) AS INTEGER) AS expectations_run,
  CAST(COUNT(*) FILTER (WHERE success) AS INTEGER) AS expectations_passed,
  CAST(COUNT(*) - COUNT(*) FILTER (WHERE success) AS INTEGER) AS expectations_failed,
  CAST(round_even(CAST(CAST((COUNT(*) FILTER (WHERE success) * 100.0 / COUNT(*) / 100.0) AS VARCHAR) AS DECIMAL(38,15)), 4) AS DOUBLE) AS pass_rate,
  bool_and(success) AS success,
  MAX(element_count) AS total_records,
  MAX(passed_records) AS passed_records,
  CASE WHEN bool_and(success) THEN 'PASSED' ELSE 'FAILED' END AS status,
  {batch_id} AS batch_id
FROM ({results}) r GROUP BY run_id"""


_SUITE, _CONTRACT = SUITE, CONTRACT
SUITE_RESULTS = suite_sql(_SUITE, SILVER)
SUITE_BY_DAY = suite_sql(_SUITE, SILVER, "event_date",
                         "concat('run_', CAST(event_date AS VARCHAR))")
CONTRACT_RESULTS = suite_sql(_CONTRACT, SILVER)
SUITE_SUMMARY = summary_from(SUITE_RESULTS, "'full_table'")
SUMMARY_BY_DAY = summary_from(SUITE_BY_DAY)

GATES = f"""
WITH s AS ({SUMMARY_BY_DAY})
SELECT run_id, pass_rate, 'G1_run_failed' AS gate FROM s WHERE NOT success
UNION ALL
SELECT run_id, pass_rate, 'G2_pass_rate' AS gate FROM s WHERE pass_rate < 0.95"""

RUN_LOG = f"""
SELECT run_id, CAST(batch_id AS VARCHAR) AS batch_id, CAST(total_records AS BIGINT) AS total_records,
  CAST(passed_records AS BIGINT) AS passed_records,
  CAST(total_records - passed_records AS BIGINT) AS failed_records,
  pass_rate, expectations_run, expectations_failed, status
FROM ({SUMMARY_BY_DAY}) s"""

NULL_RATE = f"""
SELECT COUNT(*) AS records,
  CAST(COUNT(*) FILTER (WHERE event_id IS NULL) + COUNT(*) FILTER (WHERE event_timestamp IS NULL)
       + COUNT(*) FILTER (WHERE user_id IS NULL) AS BIGINT) AS null_cells,
  CAST(COUNT(*) FILTER (WHERE event_id IS NULL) + COUNT(*) FILTER (WHERE event_timestamp IS NULL)
       + COUNT(*) FILTER (WHERE user_id IS NULL) AS DOUBLE) / CAST(COUNT(*) * 3 AS DOUBLE) AS null_rate,
  CAST(COUNT(*) FILTER (WHERE event_id IS NULL) + COUNT(*) FILTER (WHERE event_timestamp IS NULL)
       + COUNT(*) FILTER (WHERE user_id IS NULL) AS DOUBLE) / CAST(COUNT(*) * 3 AS DOUBLE) < 0.01 AS within_contract
FROM ({SILVER}) s"""


# -- analytics A9-A13 ---------------------------------------------------------------
def fraud_aggs(amounts: bool = True) -> str:
    s = ("COUNT(*) AS total_transactions, "
         "CAST(SUM(CAST(_is_fraud_label AS INT)) AS BIGINT) AS fraud_count, "
         f"{rnd('AVG(CAST(_is_fraud_label AS DOUBLE))*100', 3)} AS fraud_rate_pct")
    if amounts:
        s += f", {rnd('AVG(amount)', 2)} AS avg_amount, {rnd('SUM(amount)', 2)} AS total_amount"
    return s


PASSED = f"SELECT * FROM ({SILVER}) s WHERE dq_passed = true"
FRAUD_RATE = f"SELECT {fraud_aggs(False)} FROM ({PASSED}) p"
FRAUD_RATE_DAILY = f"SELECT event_date, {fraud_aggs(False)} FROM ({PASSED}) p GROUP BY event_date"
BY_CATEGORY = f"SELECT merchant_category, {fraud_aggs()} FROM ({PASSED}) p GROUP BY merchant_category"
BY_HOUR = f"SELECT event_hour, {fraud_aggs()} FROM ({PASSED}) p GROUP BY event_hour"
CNP_SPLIT = f"""SELECT card_presence, {fraud_aggs()} FROM (
  SELECT *, CASE WHEN is_online THEN 'CNP' WHEN NOT is_online THEN 'CP' END AS card_presence
  FROM ({PASSED}) p0) p GROUP BY card_presence"""
DQ_TREND = metrics_from(SILVER)

# -- access ---------------------------------------------------------------------
ANALYST_SILVER = f"SELECT * EXCLUDE (ip_address) FROM ({SILVER}) s"
MASKED_SILVER = (f"SELECT * REPLACE (regexp_replace(ip_address, "
                 f"'^(\\d{{1,3}}\\.\\d{{1,3}}\\.\\d{{1,3}})\\.\\d{{1,3}}$', '\\1.0') AS ip_address) "
                 f"FROM ({SILVER}) s")
STRIPPED_SILVER = f"SELECT * EXCLUDE (_is_fraud_label) FROM ({SILVER}) s"

# -- access paths and J1 --------------------------------------------------------------
RECENT = (f"SELECT * FROM ({SILVER}) s ORDER BY event_timestamp DESC NULLS LAST, "
          f"event_id DESC NULLS LAST LIMIT 100")
FOR_USER = f"SELECT * FROM ({SILVER}) s WHERE user_id = 'USR_000007'"
APPEND_ABSENT = f"""
SELECT event_id, event_date, amount FROM ({SILVER}) n
WHERE event_id IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM ({SILVER}) e WHERE e.event_date < DATE '2024-01-16' AND e.event_id = n.event_id)"""

ORACLE.update({
    "batch_metrics": METRICS,
    "batch_alerts": ALERTS,
    "expectation_results": SUITE_RESULTS,
    "expectation_results_daily": SUITE_BY_DAY,
    "contract_results": CONTRACT_RESULTS,
    "expectation_summary": SUITE_SUMMARY,
    "quality_gates": GATES,
    "run_log": RUN_LOG,
    "required_null_rate": NULL_RATE,
    "fraud_rate": FRAUD_RATE,
    "fraud_rate_daily": FRAUD_RATE_DAILY,
    "fraud_by_category": BY_CATEGORY,
    "fraud_by_hour": BY_HOUR,
    "cnp_split": CNP_SPLIT,
    "dq_trend": DQ_TREND,
    "analyst_silver": ANALYST_SILVER,
    "masked_silver": MASKED_SILVER,
    "stripped_silver": STRIPPED_SILVER,
    "recent_transactions": RECENT,
    "user_transactions": FOR_USER,
    "append_absent": APPEND_ABSENT,
})


# -- wire codec and quarantine ------------------------------------------------------
ENVELOPED_EVENTS = """(SELECT *, CAST(ts AS TIMESTAMP) AS kafka_timestamp,
  CAST(event_id % 4 AS INTEGER) AS kafka_partition,
  CAST(floor(event_id / 4) AS BIGINT) AS kafka_offset,
  event_id % 997 AS _defect, event_id % 1009 = 0 AS _null_key FROM events) e"""
WIRE_TX = transaction_select_sql(
    ENVELOPED_EVENTS, "kafka_timestamp, kafka_partition, kafka_offset, _defect, _null_key")
WIRE_SILVER = f"""SELECT * EXCLUDE (_defect, _null_key), {SILVER_FLAGS}, '1.1.0' AS _pipeline_version
FROM ({WIRE_TX}) tx"""
WIRE_ROUNDTRIP = f"SELECT * FROM ({WIRE_SILVER}) w WHERE event_id IS NOT NULL"
DECODED_SILVER = f"""SELECT * FROM ({WIRE_SILVER}) w
WHERE event_id IS NOT NULL AND NOT (CAST(substr(CAST(kafka_offset * 4 + kafka_partition AS VARCHAR), 1, 20) AS BIGINT) % 997 BETWEEN 1 AND 7)"""
# version 2 has no currency (the reader's default), version 3 no null category
AVRO_VERSIONS = f"""
SELECT *, {SILVER_FLAGS}, '1.1.0' AS _pipeline_version
FROM (SELECT * EXCLUDE (_defect, _null_key) REPLACE (
        CASE WHEN _v = 1 THEN 'USD' ELSE currency END AS currency,
        CASE WHEN _v = 2 THEN coalesce(merchant_category, 'unknown') ELSE merchant_category END AS merchant_category)
      FROM (SELECT *, (kafka_offset * 4 + kafka_partition) % 3 AS _v FROM ({WIRE_TX}) w) t) tx
WHERE event_id IS NOT NULL"""
QUARANTINE = f"""
SELECT kafka_partition, kafka_offset,
  CASE WHEN _null_key OR _defect = 1 THEN 'null_value'
       WHEN _defect = 2 THEN 'too_short'
       WHEN _defect = 3 THEN 'bad_magic'
       WHEN _defect = 4 THEN 'unknown_schema'
       WHEN _defect IN (5, 6) THEN 'decode_error'
       ELSE 'contract_violation' END AS reason,
  CASE WHEN _defect = 7 AND NOT _null_key THEN 'event_timestamp:unparseable_timestamp' END AS violation_summary
FROM {ENVELOPED_EVENTS}
WHERE _null_key OR _defect BETWEEN 1 AND 7"""
QUARANTINE_REPLAY = f"""
SELECT kafka_partition, kafka_offset, event_id, amount FROM ({WIRE_TX}) t
WHERE _defect = 4 AND NOT _null_key"""

REPLAY_LEDGER = f"""
SELECT kafka_partition, kafka_offset, CASE reason WHEN 'unknown_schema' THEN 2 ELSE 3 END::BIGINT AS attempts,
       CASE reason WHEN 'unknown_schema' THEN 'accepted' ELSE 'poison' END AS state,
       CASE WHEN reason <> 'unknown_schema' THEN reason END AS reason
FROM ({QUARANTINE}) q"""

ORACLE.update({
    "replay_ledger": REPLAY_LEDGER,
    "wire_roundtrip": WIRE_ROUNDTRIP,
    "decoded_silver": DECODED_SILVER,
    "avro_versions": f"SELECT * EXCLUDE (_v) FROM ({AVRO_VERSIONS}) a",
    "quarantine": QUARANTINE,
    "quarantine_replay": QUARANTINE_REPLAY,
})


# -- change data capture (written from the fixture's definition, not the log) ----------
S = 1_000_000_000
_ST1 = "CASE o_orderstatus WHEN 'O' THEN 'P' WHEN 'P' THEN 'F' ELSE 'O' END"
CDC_CHANGES = f"""
SELECT o_orderkey, op, CAST(p AS BIGINT) * {S} + o_orderkey AS lsn,
       CAST(floor((CAST(p AS BIGINT) * {S} + o_orderkey) / 10) AS BIGINT) AS tx_id, 'orders' AS "table"
FROM (
  SELECT o_orderkey, 0 AS p, 'r' AS op FROM orders
  UNION ALL SELECT o_orderkey, 0, 'r' FROM orders WHERE o_orderkey % 7 = 0
  UNION ALL SELECT o_orderkey, 1, 'u' FROM orders WHERE o_orderkey % 5 = 0
  UNION ALL SELECT o_orderkey, 2, 'u' FROM orders WHERE o_orderkey % 10 = 0
  UNION ALL SELECT o_orderkey, 3, 'd' FROM orders WHERE o_orderkey % 25 = 0
  UNION ALL SELECT o_orderkey, 4, 'c' FROM orders WHERE o_orderkey % 50 = 0) ch"""
CDC_BAD = "SELECT o_orderkey, 'bad_json' AS reason FROM orders WHERE o_orderkey % 997 = 3"
CDC_STATE = f"""
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 50 = 0 THEN o_orderstatus WHEN o_orderkey % 5 = 0 THEN {_ST1} ELSE o_orderstatus END AS o_orderstatus,
  CASE WHEN o_orderkey % 50 = 0 THEN o_totalprice WHEN o_orderkey % 10 = 0 THEN o_totalprice + 100.0 ELSE o_totalprice END AS o_totalprice,
  CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders WHERE o_orderkey % 50 = 0 OR o_orderkey % 25 <> 0"""
CDC_STATE_AT = f"""
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 5 = 0 THEN {_ST1} ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders"""
CDC_APPLY = f"""
SELECT s.*, CAST(CASE WHEN o_orderkey % 50 = 0 THEN 4 WHEN o_orderkey % 10 = 0 THEN 2
                      WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END AS BIGINT) * {S} + o_orderkey AS _lsn
FROM ({CDC_STATE}) s"""
CDC_AUDIT = f"""
WITH o AS (
  SELECT *, o_orderkey % 2 = 1 AS odd,
         CASE o_orderstatus WHEN 'O' THEN 'P' WHEN 'P' THEN 'F' ELSE 'O' END AS status1,
         o_totalprice + 100.0 AS price2
  FROM orders)
SELECT o_orderkey, CAST(1 AS BIGINT) * {S} + o_orderkey AS lsn, 'u' AS op,
       CASE WHEN odd THEN 'o_orderstatus' END AS column_name,
       CASE WHEN odd THEN o_orderstatus END AS old_value, CASE WHEN odd THEN status1 END AS new_value
FROM o WHERE o_orderkey % 5 = 0
UNION ALL
SELECT o_orderkey, CAST(2 AS BIGINT) * {S} + o_orderkey, 'u', CASE WHEN odd THEN 'o_totalprice' END,
       CASE WHEN odd THEN CAST(o_totalprice AS VARCHAR) END, CASE WHEN odd THEN CAST(price2 AS VARCHAR) END
FROM o WHERE o_orderkey % 10 = 0
UNION ALL
SELECT o_orderkey, CAST(3 AS BIGINT) * {S} + o_orderkey, 'd', c.column_name,
       CASE c.column_name WHEN 'o_custkey' THEN CAST(o_custkey AS VARCHAR) WHEN 'o_orderstatus' THEN status1
         WHEN 'o_totalprice' THEN CAST(price2 AS VARCHAR)
         WHEN 'o_orderdate' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) ELSE o_orderpriority END, NULL
FROM o, (VALUES ('o_custkey'), ('o_orderstatus'), ('o_totalprice'), ('o_orderdate'), ('o_orderpriority')) c(column_name)
WHERE o_orderkey % 25 = 0 AND odd
UNION ALL
SELECT o_orderkey, CAST(3 AS BIGINT) * {S} + o_orderkey, 'd', NULL, NULL, NULL FROM o WHERE o_orderkey % 25 = 0 AND NOT odd"""

ORACLE.update({
    "cdc_changes": CDC_CHANGES,
    "cdc_bad_messages": CDC_BAD,
    "cdc_state": CDC_STATE,
    "cdc_state_at_lsn": CDC_STATE_AT,
    "cdc_apply": CDC_APPLY,
    "cdc_stream_state": CDC_STATE,
    "cdc_bucketed_state": CDC_STATE,
    "cdc_replay": f"SELECT * FROM ({CDC_CHANGES}) c WHERE lsn > 2 * {S} - 1",
    "cdc_audit": CDC_AUDIT,
})


# -- velocity ----------------------------------------------------------------------------
VELOCITY = f"""
SELECT *,
  CASE WHEN event_timestamp IS NOT NULL AND user_id IS NOT NULL THEN COUNT(*) OVER w END AS velocity_count,
  CASE WHEN event_timestamp IS NOT NULL AND user_id IS NOT NULL THEN {rnd('SUM(amount) OVER w', 2)} END AS velocity_amount,
  CASE WHEN event_timestamp IS NOT NULL AND user_id IS NOT NULL THEN COUNT(*) OVER w > 3 END AS velocity_alert
FROM ({TX}) tx
WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp
             RANGE BETWEEN INTERVAL 1440 MINUTES PRECEDING AND CURRENT ROW)"""
VELOCITY_WINDOWS = f"""
SELECT user_id, make_timestamp(ws) AS window_start, make_timestamp(ws + 600000000) AS window_end,
  COUNT(*) AS velocity_count, {rnd('SUM(amount)', 2)} AS velocity_amount
FROM (SELECT tx.*, (epoch_us(event_timestamp) // 60000000 - r.k) * 60000000 AS ws
      FROM ({TX}) tx, range(0, 10) r(k)) x
GROUP BY user_id, ws"""
ORACLE.update({"velocity": VELOCITY, "velocity_split": VELOCITY,
               "velocity_windows": VELOCITY_WINDOWS, "velocity_stream": VELOCITY})

ORACLE["stream_silver"] = DECODED_SILVER
ORACLE["stream_quarantine"] = QUARANTINE

# every flag must follow from its row's score and threshold
ORACLE["anomaly_flags"] = f"""
SELECT count(*) AS rows, 0::BIGINT AS wrong_flags, 0::BIGINT AS bad_scores, 1::BIGINT AS thresholds FROM ({TX}) tx"""
ORACLE["stream_bronze"] = f"SELECT * FROM ({DECODED_SILVER}) s"

# only the later half of the producers fills the new column
ORACLE["stream_evolved"] = f"""
SELECT *, CASE WHEN (kafka_offset * 4 + kafka_partition) % 2 = 1 THEN CASE WHEN is_online THEN 'web' ELSE 'pos' END END AS channel
FROM ({WIRE_ROUNDTRIP}) w"""
# redelivered messages are copies: every accepted event once
ORACLE["stream_deduped"] = WIRE_ROUNDTRIP
ORACLE["shap_audit"] = f"SELECT count(*) AS rows, 0::BIGINT AS wrong_sums, 1::BIGINT AS baselines FROM ({TX}) tx"

ORACLE["anomaly_index"] = f"SELECT count(*) - count(*) AS unequal_rows FROM ({TX}) tx"

SILVER_AGAIN = f"""
SELECT * FROM ({SILVER}) s UNION ALL SELECT * FROM ({SILVER}) t WHERE event_hour = 3
UNION ALL SELECT * FROM ({SILVER}) u WHERE event_hour = 3 AND is_online"""
ORACLE["duplicate_expectations"] = suite_sql(_SUITE, SILVER_AGAIN)
ORACLE["duplicate_expectations_daily"] = suite_sql(_SUITE, SILVER_AGAIN, "event_date", "concat('run_', CAST(event_date AS VARCHAR))")
