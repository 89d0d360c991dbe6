"""Session settings and the shared scratch area.

Every job and query calls :func:`configure` on the session it is given.  It
sets runtime SQL settings that the session's owner has not set, so a session
built by a cluster launcher keeps its own configuration.

Scratch output (stream checkpoints, written tables, read-back copies) lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when the
session has none (local tests) do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Runtime SQL settings every entry point relies on.
RUNTIME_CONF = {
    # All event times are UTC wall-clock values.
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on a proven size: no broadcast from static file-size
    # estimates (compressed Parquet can be far larger in memory); AQE may
    # still switch a join to broadcast from the exact size of a finished
    # shuffle stage, and explicit hints come after a row-count check.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    # Reruns of a day replace that day's partition only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


#: Session setting that says the defaults have been applied.
APPLIED = "spark.tidemark.configured"

# Starting points for a large cluster, used by the batch job entry points.
# AQE starts from many shuffle partitions and coalesces them toward the
# advisory size, so one setting serves a small day and a 100 TB backfill;
# Parquet scans are split at 256 MB.
CLUSTER_BATCH_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
}

# Stream jobs: the number of state partitions is the shuffle partition count
# at the first start of a checkpoint and cannot change later, so a fixed
# number is used.  State lives in RocksDB on the executors' disks, with its
# changes in the checkpoint, so a large replay doesn't have to fit in memory.
CLUSTER_STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.shuffle.partitions": "400",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Defaults for a session that others made.  What was set when it was
    started (``--conf``) stays, and what is changed afterwards too: the
    defaults are applied once per session."""
    if spark.conf.get(APPLIED, None) is None:
        given = spark.sparkContext.getConf()
        for key, value in RUNTIME_CONF.items():
            if not given.contains(key):
                spark.conf.set(key, value)
        spark.conf.set(APPLIED, "true")
    return spark


def build_session(
    master: str | None = None,
    app_name: str = "tidemark",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Session for jobs and tests.  On a cluster, leave ``master`` unset and
    let spark-submit supply it.  ``extra`` holds defaults as well: a setting
    given to spark-submit with ``--conf`` comes first."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RUNTIME_CONF)
    conf.update({"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    given = SparkConf()
    for key, value in conf.items():
        if not given.contains(key):
            builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared scratch area: ``spark.checkpoint.dir`` as the
    cluster sets it.  Only a local-mode session without one (tests) gets a
    temporary folder; on a cluster a missing setting is an error, since a
    machine-local folder would not survive the loss of that machine."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set: give the cluster's shared folder "
            "(for example --conf spark.checkpoint.dir=s3a://bucket/checkpoints)"
        )
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the shared scratch area."""
    return f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"
