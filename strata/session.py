"""Session construction and the few session settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings a load job wants on any cluster: adaptive execution (coalescing,
# skew-join splitting, runtime broadcast choice), runtime bloom filters (a
# fact joined to a selectively filtered fact -- a one-month P&L over all line
# items -- is pruned before its shuffle), UTC wall clock so window bounds mean
# the same thing everywhere, and dynamic partition overwrite so a partitioned
# write rewrites only the partitions it touches.
DEFAULT_CONF = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Checkpoints go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "strata",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given: on a cluster the launcher decides.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only a local session may
    do without it (tests): a scratch folder is made and registered.  On any
    other master each executor would write to its own disk, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or None
    sc = spark.sparkContext
    configured = configured or sc.getCheckpointDir()
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured
