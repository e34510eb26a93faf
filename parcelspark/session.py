"""Spark session helpers.

The library never creates a session implicitly inside an operator; callers pass
one in.  ``get_session`` is a convenience for tests, the bench and scripts.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins at runtime (broadcast a side
# only once its real size is known, split skewed partitions, coalesce tiny ones).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; above that size let Spark
    # fall back from whole-stage codegen to per-expression code (Spark's advice for HotSpot).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "parcelspark", shared: str | None = None) -> SparkSession:
    """A session for tests, the bench and scripts; ``shared`` is the folder for written tables."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    builder = builder.config("spark.driver.memory", os.environ.get("PARCELSPARK_DRIVER_MEM", "16g"))
    for k, v in SCALE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if shared is not None:
        builder = builder.config("spark.checkpoint.dir", shared)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from ``spark.checkpoint.dir``.

    The library makes no folder of its own: a machine-local one would be missing on
    the other machines.  Tests and the bench configure a scratch folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return path


def shuffle_partitions_for(input_bytes: int, target_bytes: int = 2 << 30, minimum: int = 200, most: int = 50_000) -> int:
    """Initial shuffle partitions for an input of ``input_bytes``: about ``target_bytes`` of input per partition.

    The driver keeps an entry for every map task and partition, so both stay in the tens of thousands:
    100 TB gives 50,000 partitions of 2 GB (AQE coalesces small ones and splits skewed ones)."""
    return max(minimum, min(most, -(-int(input_bytes) // int(target_bytes))))


def cluster_conf(input_bytes: int) -> dict[str, str]:
    """Settings for a large cluster run on top of :data:`SCALE_CONF`."""
    n = shuffle_partitions_for(input_bytes)
    return {**SCALE_CONF,
            # as many map splits as partitions at most: one to two GB each at 100 TB
            "spark.sql.files.maxPartitionBytes": str(min(2 << 30, max(128 << 20, int(input_bytes) // 50_000))),
            "spark.sql.shuffle.partitions": str(n),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
            "spark.sql.autoBroadcastJoinThreshold": "64MB",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB"}
