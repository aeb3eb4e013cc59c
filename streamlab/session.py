"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Settings that change results or plans. Sizes (memory, partitions) belong to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Arbitrary state (timers, map and list state) needs the RocksDB store; it also keeps
    # large state off the JVM heap.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

#: Can only be set when a session is built. Call sites in error messages cost more than planning.
STATIC_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def build_session(app: str = "streamlab", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **STATIC_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the settings on a session that someone else built."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
