"""Session settings and the shared staging folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Settings every job relies on. ANSI mode is on in Spark 4, so the library
# uses try_* functions wherever bad input must become null instead of failing.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Parsing pages costs far more CPU than its bytes suggest: do not let AQE
    # merge small shuffle partitions below 64 KB (the 1 MB default packs a
    # few MB of pages into 2-4 tasks). Large inputs are unaffected.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Remove reliable-checkpoint files once their DataFrame is unreachable.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Settings for a large cluster (about 1000 executors, ~100 TB of input).
# Shuffles start wide and AQE coalesces them to ~256 MB partitions; scans
# split at 256 MB; tables up to 64 MB (measured) are broadcast; a shuffle
# partition over 5x the median and 512 MB is split by the skew-join rule.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.files.maxRecordsPerFile": "20000000",
}


def build_session(master: str | None = None, app: str = "gaugeflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None, profile: str = "local") -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``profile="cluster"`` adds CLUSTER_CONF (large-cluster sizing).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_conf(spark)
    return spark


def apply_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable (SQL) part of SESSION_CONF to an existing session."""
    for key, value in SESSION_CONF.items():
        if key.startswith("spark.sql."):
            spark.conf.set(key, value)


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a folder every executor can reach; the
    library never falls back to a machine-local folder by itself. ``fallback``
    is only used where the setting is unset (tests pass a scratch folder).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if fallback is None:
            raise RuntimeError("spark.checkpoint.dir is not set")
        root = fallback
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint root for staged writes."""
    return f"{checkpoint_root(spark)}/gaugeflow-stage/{name}-{uuid.uuid4().hex}"
