"""Session settings the engine is meant to run with."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime settings for a cluster: AQE sizes and splits shuffle partitions, and may split a
# hot key's partition even where that costs one more exchange.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    # Lists of keys reach the readers' Bloom filters and statistics as they are.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    for name, value in CLUSTER_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str | int | None = None, partitions: int = 8) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("staywise")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Small local shuffles are CPU-bound: keep them on all cores instead of merging
        # partitions up to the default of 1 MB.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
    )
    spark = apply_settings(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    # A single machine shares its own folders; clusters name theirs in spark.checkpoint.dir.
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="staywise-"))
    return spark
