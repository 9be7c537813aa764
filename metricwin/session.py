"""Session settings this package is meant to run with. The caller owns the session."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Times of day are wall-clock text; every job reads and prints them in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State of the streaming jobs lives off-heap and is checkpointed as changes.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply ``SETTINGS``; on a cluster pass ``shuffle_partitions`` generously.

    Adaptive execution merges small shuffle partitions but cannot split an aggregation's
    large ones, so start from about (bytes shuffled / 128 MB) partitions.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if shuffle_partitions is not None:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark
