"""Session settings the jobs rely on."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Rows are stored with instants; a fixed zone keeps text timestamps and months the same on every cluster.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # AQE merges small shuffle partitions, splits skewed join partitions (a merchant or customer holding a large part of
    # all rows) and turns sort-merge joins into broadcast joins when the measured side is small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

SHUFFLE_BYTES_PER_PARTITION = 128 * 1024 * 1024


def initial_shuffle_partitions(shuffle_bytes: int, cores: int) -> int:
    """Partitions to start a shuffle with: about 128 MB each and two waves at least; AQE merges what is too small."""
    by_size = -(-shuffle_bytes // SHUFFLE_BYTES_PER_PARTITION)
    return max(by_size, 2 * cores)


def configure(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply the settings that may change at run time to a session the cluster handed out."""
    for key, value in BASE_CONF.items():
        spark.conf.set(key, value)
    if shuffle_bytes is not None:
        cores = spark.sparkContext.defaultParallelism
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", initial_shuffle_partitions(shuffle_bytes, cores)
        )
    return spark


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries made in here remove their shuffle files when they end. Otherwise the files stay until the driver happens to
    collect its garbage, so that a job of many queries fills the disks with the shuffles of all of them."""
    before = spark.conf.get(FREED, None)
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED) if before is None else spark.conf.set(FREED, before)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("ledgerline")
        .config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
