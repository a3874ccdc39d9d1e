"""ledgerlake: card-transaction analytics as Spark DataFrame / SQL / Structured
Streaming operators.

Every public function takes and returns DataFrames (or returns a
StreamingQuery at the very edge); actions happen only in sinks and in the few
bounded driver-side steps documented where they occur.
"""

from ledgerlake.functions.wire import accepted, decode, encode
from ledgerlake.operators.access import mask_ip, role_view, strip_label
from ledgerlake.operators.analytics import by_category, by_hour, cnp_split, dq_trend, fraud_rate
from ledgerlake.operators.cdc import (apply_changes, audit, changes_since, parse_changes,
                                      quarantined_changes, state_at)
from ledgerlake.operators.expectations import (append_run_log, gates, null_rate, passes_gate,
                                               run_expectations, run_log_rows, summarise,
                                               write_summary_json)
from ledgerlake.operators.forest import fraud_signals, score, score_silver, train_forest
from ledgerlake.operators.gold import category_ranking_sql, gold_summary, gold_summary_sql, write_gold
from ledgerlake.operators.metrics import alerts, batch_metrics
from ledgerlake.operators.quarantine import expire, quarantined, replay, write_quarantine
from ledgerlake.operators.signals import anomalies, append_absent, for_user, recent
from ledgerlake.operators.silver import to_silver
from ledgerlake.operators.velocity import velocity, velocity_windows
from ledgerlake.session import build_session, checkpoint_dir
from ledgerlake.sources.kafka import envelope, read_kafka_stream
from ledgerlake.sources.tables import load_table, transactions_from_events
from ledgerlake.streaming.jobs import start_stream, velocity_stream

__all__ = [
    "accepted", "alerts", "anomalies", "append_absent", "append_run_log", "apply_changes",
    "audit", "batch_metrics", "build_session", "by_category", "by_hour", "changes_since",
    "checkpoint_dir", "cnp_split", "decode", "dq_trend", "encode", "envelope", "expire",
    "category_ranking_sql", "for_user", "fraud_rate", "fraud_signals", "gates", "gold_summary", "gold_summary_sql",
    "load_table", "mask_ip", "null_rate", "parse_changes", "passes_gate", "quarantined",
    "quarantined_changes", "read_kafka_stream", "recent", "replay", "role_view",
    "run_expectations", "run_log_rows", "score", "score_silver", "start_stream", "state_at",
    "strip_label", "summarise", "to_silver", "train_forest", "transactions_from_events",
    "velocity", "velocity_stream", "velocity_windows", "write_gold", "write_quarantine",
    "write_summary_json",
]
