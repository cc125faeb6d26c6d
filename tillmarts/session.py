"""Session settings the library is written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Everything here is a session default that a cluster's own submit settings may override.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot key (one variant, office or NULL code holding a large share of the lines) is split by
    # the runtime planner instead of landing in one task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ... even where the split costs another shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def build_session(
    app_name: str = "tillmarts",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Create or reuse a session. ``extra`` takes settings with ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
