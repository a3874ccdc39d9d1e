"""The driver contract in __spark_entry__.py."""

import re

import __spark_entry__ as E


def test_oracles_cover_only_registered_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    core = [k for k in q if not re.match(r"op\d+_", k) and k != "pipeline"]
    assert len(core) >= 40 and len(set(core) & set(o)) >= 35


def test_entry_is_the_gold_summary(spark):
    df = E.entry(spark)
    assert df.columns == ["event_date", "merchant_category", "total_transactions", "fraud_count",
                          "fraud_rate_pct", "avg_amount", "max_amount", "total_amount",
                          "online_count", "high_risk_country_count"]
    assert df.count() == 287


def _python(code, conf_dir):
    import os
    import subprocess
    import sys
    env = {**os.environ, "SPARK_CONF_DIR": str(conf_dir), "PYTHONPATH": os.path.dirname(os.path.dirname(__file__))}
    return subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=300)


def test_session_works_without_preset_configuration(tmp_path):
    out = _python("from ledgerlake.session import build_session, checkpoint_dir\n"
                  "s = build_session('local[2]')\n"
                  "print('dir', bool(checkpoint_dir(s)), s.range(5).checkpoint().count())", tmp_path)
    assert "dir True 5" in out.stdout, out.stderr[-500:]


def test_a_cluster_without_a_shared_folder_raises():
    import pytest
    from types import SimpleNamespace

    from ledgerlake.session import checkpoint_dir
    sc = SimpleNamespace(master="yarn", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d)))
