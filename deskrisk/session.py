"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE carries most of the physical decisions: it turns a shuffle join into a
# broadcast join only once the small side has been measured, splits skewed join
# partitions, and merges small ones after each shuffle.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


# What one task should get of a shuffle, so that it sorts and aggregates in memory.
SHUFFLE_BYTES_PER_TASK = 128 << 20


def shuffle_partitions(shuffled_bytes: int) -> int:
    """Partitions for the largest shuffle expected. AQE merges those that stay small, but
    it cannot divide one that a plain aggregation left too large, so err on the high side."""
    return max(200, min(100_000, shuffled_bytes // SHUFFLE_BYTES_PER_TASK))


def build_session(
    app_name: str = "deskrisk", master: str | None = None, shuffled_bytes: int | None = None, **extra: str
) -> SparkSession:
    """A session with the settings above; ``extra`` uses ``__`` for dots in names.

    ``shuffled_bytes`` is the size of the largest shuffle: for a full refresh, that of
    the positions as they are loaded.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    if shuffled_bytes is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions(shuffled_bytes)))
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()
