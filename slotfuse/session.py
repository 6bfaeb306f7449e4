"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE does the sizing: start from many shuffle partitions, let it merge small ones,
# split skewed join partitions, and never trade that split for a saved shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}


def build_session(
    app_name: str = "slotfuse",
    master: str | None = None,
    shuffle_partitions: int = 4000,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with `SETTINGS`; `master` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        **(extra or {}),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
