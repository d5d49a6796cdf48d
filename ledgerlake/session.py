"""Session construction and the shared scratch location.

The library never builds its own session inside an operator; callers pass
one in.  ``local_session`` is for tests and the benchmark only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


# Settings for a large cluster (put them in spark-defaults or pass with
# --conf).  Shuffles start wide and AQE coalesces them to ~256 MiB, so one
# setting serves an hourly window and a full-history rebuild alike; skewed
# join partitions are split; scans cut files into 256 MiB splits.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "32768",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.shuffle.partitions": "32768",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    # spark.checkpoint.dir: a shared folder (HDFS / object store) chosen by
    # the cluster; the library reads it and never sets it there.
}


def local_session(cores: str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerlake") -> SparkSession:
    """A local session with the settings the library is tuned for.

    On a cluster the same keys belong in spark-defaults: AQE with partition
    coalescing and skew-join splitting, UTC session time, no UI.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates and checkpoints.

    Uses the session's ``spark.checkpoint.dir`` (set by the cluster to a
    shared file system).  Only a local-mode session without that setting
    (tests) gets a fresh temporary folder, which is then recorded in the
    session so later calls and ``checkpoint()`` agree.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; on a cluster it must name a "
            "shared folder (e.g. on HDFS or an object store)")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="ledgerlake-", dir="/tmp"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the scratch root for one written table."""
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
