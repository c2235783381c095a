"""Session settings.

On a cluster the session comes from ``spark-submit``; ``apply_job_conf`` sets
what every job relies on. ``local_session`` is for tests and the benchmark.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on: AQE re-plans joins (broadcast when the
# runtime size is small, skew split otherwise) and coalesces partitions.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "searchlens",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("SEARCHLENS_DRIVER_MEMORY", "8g"))
        # Local mode runs every task in the driver JVM; the throughput collector
        # suits these short, allocation-heavy tasks better than G1.
        .config("spark.driver.extraJavaOptions", os.environ.get("SEARCHLENS_JAVA_OPTS", "-XX:+UseParallelGC"))
    )
    for k, v in {**JOB_CONF, **(extra_conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_job_conf(spark: SparkSession) -> None:
    """Set ``JOB_CONF`` on a running session."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)


def cluster_conf(input_bytes: int, shuffle_fraction: float = 0.1, scan_split_bytes: int = 1 << 30,
                 shuffle_partition_bytes: int | None = None, broadcast_bytes: int = 64 << 20,
                 executor_memory_bytes: int | None = None, executor_cores: int = 4) -> dict[str, str]:
    """Settings to pass to ``spark-submit`` for a job that reads ``input_bytes``.

    Shuffle partitions are sized so one fits in a task's share of execution
    memory (half of ``0.6 x executor memory / cores``, leaving room for hash
    tables and sort buffers), at most 512 MiB; without an executor size, 512 MiB.

    - Scan splits of ``scan_split_bytes`` (1 GiB): 100 TB gives ~100k scan
      tasks, so the driver's task and map-status bookkeeping stays bounded.
    - Shuffle partitions sized for the bytes that actually cross the shuffle
      (``shuffle_fraction`` of the input, since columns are pruned and
      aggregates combine map-side), at ``shuffle_partition_bytes`` each and at
      least 200; AQE then coalesces small ones and splits skewed ones.
    - Broadcast threshold (static and AQE) of 64 MiB: catalog-size tables
      are broadcast, anything larger is sort-merge joined.
    - Executor loss: an external shuffle service keeps map output readable
      when an executor dies, and decommissioning migrates shuffle and cached
      blocks off executors that are being taken away, so lost executors cost
      a retry of their running tasks rather than a rerun of earlier stages.
    - zstd for shuffle and spill blocks: fewer bytes over the network at scale.
    """
    if shuffle_partition_bytes is None:
        shuffle_partition_bytes = 512 << 20
        if executor_memory_bytes:
            shuffle_partition_bytes = min(shuffle_partition_bytes, int(executor_memory_bytes * 0.6 / executor_cores / 2))
    shuffle_bytes = int(input_bytes * shuffle_fraction)
    partitions = max(200, -(-shuffle_bytes // shuffle_partition_bytes))
    return {
        **JOB_CONF,
        "spark.sql.files.maxPartitionBytes": str(scan_split_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_partition_bytes // 2),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(shuffle_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_bytes),
        "spark.shuffle.service.enabled": "true",
        "spark.decommission.enabled": "true",
        "spark.storage.decommission.enabled": "true",
        "spark.storage.decommission.shuffleBlocks.enabled": "true",
        "spark.storage.decommission.rddBlocks.enabled": "true",
        "spark.io.compression.codec": "zstd",
    }
