"""Session construction and shared-folder helpers.

The library never hard-codes a shuffle partition count for production: the
cluster's own settings win.  ``build_session`` only fills in settings that are
unset, so the same code runs in tests (local[*]) and on a cluster.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on.  The time zone is pinned because event_date /
# event_hour are derived from timestamps and must not depend on the host.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
# Idempotent sinks pass ``partitionOverwriteMode=dynamic`` per write; it is
# not set session-wide so other overwrites in the session keep their meaning.


def build_session(master: str | None = None, app_name: str = "ledgerlake",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Return a session with the library's required settings.

    ``master``/``shuffle_partitions`` are for local runs; on a cluster leave
    them ``None`` so spark-submit's configuration is used.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Reads ``spark.checkpoint.dir`` from the session, or the folder that was
    given to ``SparkContext.setCheckpointDir``.  Where both are unset a local
    session (tests, trials) gets a fresh temporary folder; any other master
    raises, because its executors could not see such a folder.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)               # DataFrame.checkpoint() uses it
        return d.rstrip("/")
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not (sc.master == "local" or sc.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    import tempfile
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def spread(df):
    """Give a CPU-heavy per-row stage at least one task per core.

    When a *batch* input arrives in fewer partitions than the cluster's
    default parallelism (e.g. one small file with one row group), rows are
    dealt round-robin over that many partitions.  At scale the scan already
    has far more splits than cores and this is a no-op (no extra shuffle);
    streaming inputs are left alone.
    """
    if df.isStreaming:
        return df
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan or "AdaptiveSparkPlan" in plan:
        return df          # already spread by a shuffle; .rdd would run it early
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def ship_package(spark: SparkSession) -> None:
    """Make ``ledgerlake`` importable in Python workers (what ``--py-files``
    does at submit time), once per SparkContext.

    The package is zipped in memory, written through the Hadoop FileSystem API
    into the session's shared checkpoint folder (local or remote), and added
    with ``SparkContext.addPyFile``; Spark ships it to every executor.
    """
    import hashlib
    import io
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_ledgerlake_shipped", False):
        return
    pkg_root = os.path.dirname(os.path.abspath(__file__))
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in sorted(os.walk(pkg_root)):
            if "__pycache__" in dirpath:
                continue
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    arc = os.path.join("ledgerlake", os.path.relpath(full, pkg_root))
                    z.write(full, arc)
    data = buf.getvalue()
    digest = hashlib.sha1(data).hexdigest()[:12]
    target = f"{checkpoint_dir(spark)}/_code/ledgerlake-{digest}.zip"
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(path):
        out = fs.create(path, True)
        try:
            out.write(bytearray(data))
        finally:
            out.close()
    sc.addPyFile(target)
    sc._ledgerlake_shipped = True
