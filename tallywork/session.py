"""Settings these jobs are written for.

Nothing in the library changes a session; pass the settings to your builder.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Sizes are decided at run time: partitions are merged, skewed ones split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Results that name days and hours must not depend on where they run.
    "spark.sql.session.timeZone": "UTC",
    # Streaming state outside the heap, with only its changes written per batch.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """A session builder with the settings applied."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
