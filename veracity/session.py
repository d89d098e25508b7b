"""Spark session settings shared by tests, the bench and the jobs.

Operators never create sessions; they take DataFrames. This module only
builds a session for local runs and makes sure a checkpoint folder exists.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. AQE re-plans joins from runtime sizes
# (broadcast only when the measured side is under the threshold), coalesces
# small shuffle partitions and splits skewed join partitions.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.ui.enabled": "false",
}


def local_session(cpus: int | None = None, shuffle_partitions: int | None = None,
                  app: str = "veracity") -> SparkSession:
    """A local session for tests and the bench; clusters pass their own."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
               .config("spark.driver.memory", os.environ.get("VERACITY_DRIVER_MEMORY", "16g"))
               .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; invent one only locally.

    On a cluster the folder must be on shared storage that survives executor
    loss, so it has to come from the session. Only a local master (tests, the
    bench) gets a fresh scratch folder when the setting is absent.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
    path = tempfile.mkdtemp(prefix="veracity-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cluster_conf(input_bytes: int, executor_cores_total: int,
                 target_partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Shuffle and scan sizing for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at ~one per ``target_partition_bytes`` of input
    (and at least 3 waves of the available cores); AQE then coalesces small
    ones and splits skewed ones. Pass the result to the session builder.
    """
    parts = max(3 * executor_cores_total, -(-input_bytes // target_partition_bytes))
    conf = dict(BASE_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    })
    return conf
