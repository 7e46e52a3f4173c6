"""SparkSession defaults for running the reports.

On a cluster the session comes from the platform. ``build_session`` sets the
defaults below over the cluster's; ``spark.checkpoint.dir`` and, unless an
argument names them, the shuffle partitions stay as the cluster has them.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the reports rely on. AQE re-plans joins on measured sizes (a join
# side is broadcast only when its materialised size is under the threshold,
# sort-merge otherwise), coalesces small shuffle partitions and splits skewed
# ones.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # PySpark otherwise records the Python call site of every DataFrame/Column
    # call (several JVM round trips each) just to enrich error messages.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "donorlens", extra: dict | None = None) -> SparkSession:
    """Create or reuse a session; local defaults apply only when nothing is set."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is used
    as is. Only a bare local session (tests) gets a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="donorlens-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder for written intermediate tables, under the shared checkpoint dir."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "donorlens", name)
