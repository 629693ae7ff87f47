"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import gc
import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes. AQE re-plans joins and
# coalesces shuffle output at run time; UTC keeps date/timestamp text stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "pitchstar",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster ``master`` stays None so the launcher decides; tests pass
    ``local[*]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only in local mode.

    On a cluster the folder must be shared storage named by
    ``spark.checkpoint.dir``; we never invent a machine-local one there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at shared storage "
            "(HDFS/S3/ABFS) before running jobs that cut lineage")
    path = tempfile.mkdtemp(prefix="pitchstar-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop shuffle files of finished jobs now; it acts when
    the driver's JVM finds their plans unreachable."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def cluster_conf(total_cores: int, input_tb: float = 100.0) -> dict:
    """Sizing for a large cluster, to pass as ``extra`` (or spark-submit
    --conf). Scan splits of 256 MB keep a 100 TB scan near 400k tasks;
    shuffles start with enough partitions for ~200 MB each at the largest
    stage (the event fact) and AQE coalesces them down to ~128 MB; skew
    splitting kicks in at 5x the median and 512 MB.

    Each task's working set (one 256 MB split or one ~128-256 MB shuffle
    partition) fits an executor core's share of memory with room to spill.
    """
    largest_stage_bytes = input_tb * 1e12 * 0.4        # the event fact dominates
    shuffle_parts = max(3 * total_cores, int(largest_stage_bytes / 200e6))
    return {
        "spark.sql.files.maxPartitionBytes": "256m",
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # dims under 64 MB are broadcast by Spark itself (size statistics)
        "spark.sql.autoBroadcastJoinThreshold": "64m",
    }
