"""Session and shared-folder helpers.

Every job that materialises data (stream checkpoints, round-trip writes,
lineage cuts, saved models) writes below the folder named by the cluster in
``spark.checkpoint.dir``.  Only when that setting is absent *and* the master is
local (tests, laptops) do we create a scratch folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "framewise") -> SparkSession:
    """Session used by tests and the bench (the driver passes its own)."""
    master = master or os.environ.get("FRAMEWISE_MASTER", "local[*]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FRAMEWISE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int = 4,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at about one per ``target_partition_bytes`` of
    input, two waves of cores at least.  AQE coalesces them to the
    advisory size from measured map output and splits skewed join partitions.
    File splits stay at 256 MB so a scan task holds one row-group window."""
    cores = executors * cores_per_executor
    partitions = max(2 * cores, input_bytes // target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and materialised tables.

    Read from ``spark.checkpoint.dir``; a local-mode session without it gets
    a fresh scratch folder (tests only).  A non-local session must name one.
    """
    conf_dir = spark.conf.get(CHECKPOINT_CONF, None)
    if not conf_dir:
        conf_dir = spark.sparkContext.getConf().get(CHECKPOINT_CONF, None)
    if not conf_dir:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="framewise-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, conf_dir)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir.rstrip("/")


def fresh_path(spark: SparkSession, kind: str) -> str:
    """A new, unused path below the shared folder (one per run)."""
    return f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex[:12]}"
