"""Audit the core queries' physical plans (printed as a markdown table).

Flags cartesian / nested-loop joins and row-at-a-time Python UDFs, lists the
Arrow-batched Python stages and counts exchanges.

Usage: python tools/audit_plans.py [sf_dir] >> PLANS.md
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ledgerlake.session import build_session  # noqa: E402

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")
PY = ("MapInArrow", "MapInPandas", "FlatMapGroupsInPandas", "FlatMapGroupsInArrow")


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerlake.plans.registry import QUERIES
    print(f"\n## Plan audit of the core queries ({sf_dir})\n")
    print("| query | exchanges | cartesian / nested-loop / row UDF | Arrow-batched Python |")
    print("|---|---|---|---|")
    for name, fn in QUERIES.items():
        plan = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        bad = [b for b in BAD if b in plan] or ["none"]
        py = [p for p in PY if p in plan] or ["-"]
        print(f"| {name} | {plan.count('Exchange ')} | {', '.join(bad)} | {', '.join(py)} |")
    spark.stop()


if __name__ == "__main__":
    main()
