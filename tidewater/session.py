"""Spark session with the settings the engine expects."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(app: str = "tidewater", master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """ANSI stays on, UTC, adaptive execution; ``conf`` keys use '__' for '.'."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.ui.enabled", "false")
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
