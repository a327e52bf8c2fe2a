"""Session helpers: scale-oriented defaults and a shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins (runtime broadcast of
# small sides, skew splitting) and coalesces small shuffle partitions; the
# partition counts below are sized for local runs and are meant to be
# overridden per cluster (target ~128-256 MB per shuffle partition).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
}


# Settings for a large cluster run (apply with ``apply_cluster_conf``).  AQE
# sizes post-shuffle partitions by bytes instead of maximising the count,
# scans read ~256 MB splits, and the shuffle partition count follows the
# input size (see ``shuffle_partitions_for``).  Not used by local runs,
# where parallelism-first coalescing keeps all cores busy on small data.
CLUSTER_CONF = {
    **SCALE_CONF,
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}
TARGET_PARTITION_BYTES = 256 * 1024 * 1024


def shuffle_partitions_for(input_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES, minimum: int = 200) -> int:
    """Initial shuffle partition count so each partition holds about
    ``target_bytes`` (AQE then coalesces or splits at run time)."""
    return max(minimum, -(-int(input_bytes) // target_bytes))


def apply_cluster_conf(spark: SparkSession, input_bytes: int | None = None) -> None:
    """Set the cluster profile on a running session (runtime SQL settings only)."""
    for key, value in CLUSTER_CONF.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions_for(input_bytes)))


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerflow") -> SparkSession:
    """Session for tests and local benchmarks (UI off, no server ports)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("LEDGERFLOW_DRIVER_MEMORY", "16g"))
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names a shared file system folder and is
    only read.  Only a local session (tests), whose executors share this
    machine's disk, gets a folder made here when it is unset.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = tempfile.mkdtemp(prefix="ledgerflow-ckpt-")
    spark.sparkContext.setCheckpointDir(configured)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder; on a cluster there is
    none without that setting, so nothing lands on one machine's disk."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerflow-scratch/{name}-{uuid.uuid4().hex[:12]}"
