"""Write PLANS.md: physical plans of the headline operators.

Usage: python tools/show_plans.py [sf_dir]

Plans are taken before execution (AQE may still coalesce partitions or turn a
join into a broadcast at run time).  Gold and the suite are also shown over a
stored silver table partitioned by ``event_date`` -- the production layout --
to show partition pruning and filter push-down into the Parquet scan.
"""

from __future__ import annotations

import os
import sys
import uuid

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import functions as F  # noqa: E402

from ledgerlake.operators import cdc as CD  # noqa: E402
from ledgerlake.operators import expectations as EX  # noqa: E402
from ledgerlake.operators import gold as G  # noqa: E402
from ledgerlake.operators import velocity as VE  # noqa: E402
from ledgerlake.plans import registry as R  # noqa: E402
from ledgerlake.session import build_session, checkpoint_dir  # noqa: E402
from ledgerlake.sources.changes import ORDER_KEY, PHASE_STRIDE  # noqa: E402


def plan_text(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    stored = f"{checkpoint_dir(spark)}/plans-{uuid.uuid4().hex[:8]}"
    R.silver_df(spark, sf_dir).write.partitionBy("event_date").parquet(stored)
    silver = spark.read.parquet(stored)
    valid = R._valid(spark, sf_dir).checkpoint()
    table = CD.state_at(valid, ORDER_KEY, lsn=2 * PHASE_STRIDE - 1, keep_lsn=True).checkpoint()
    shown = [
        ("Gold summary over stored silver, one week (pruning + push-down)",
         G.gold_summary(silver.filter(F.col("event_date") >= F.lit("2024-01-24").cast("date")))),
        ("Expectation suite over stored silver (one aggregate + uniqueness by grouped count)",
         EX.run_expectations(silver)),
        ("Silver from the given events table (one narrow projection)",
         R.silver_df(spark, sf_dir)),
        ("Velocity, exact trailing window (one exchange, growing frames)",
         VE.velocity(R._tx(spark, sf_dir))),
        ("CDC latest state (combinable max(struct) aggregate)",
         CD.state_at(valid, ORDER_KEY)),
        ("CDC merge of a change batch into a stored table (split by the touched keys)",
         CD.apply_changes(table, CD.changes_since(valid, 2 * PHASE_STRIDE - 1), ORDER_KEY)),
    ]
    out = ["# Physical plans of headline operators",
           "",
           f"Generated by `python tools/show_plans.py {sf_dir}` (local[8], 8 shuffle partitions).",
           "Plans are pre-execution; AQE may coalesce partitions or switch joins at run time.",
           ""]
    for title, df in shown:
        out += [f"## {title}", "", "```", plan_text(df).strip(), "```", ""]
    open(os.path.join(ROOT, "PLANS.md"), "w").write("\n".join(out))
    spark.stop()


if __name__ == "__main__":
    main()
