"""Session settings that suit these operators; all are optional and none changes a result."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Top-n per group prunes in the map tasks up to this n. Spark's default of 1000 is below the usual job target.
    "spark.sql.optimizer.windowGroupLimitThreshold": "10000",
    # Re-plans joins by measured sizes and splits skewed join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Keeps the state of `stream_sightings` on disk; Spark's default keeps it on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the settings to a session builder."""
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    return builder
