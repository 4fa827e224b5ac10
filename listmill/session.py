"""Sessions with the settings that the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """UTC, adaptive execution, Arrow. On a cluster leave master and partitions to its own settings."""
    builder = SparkSession.builder.appName("listmill").config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.execution.arrow.pyspark.enabled", "true")
    if master:
        builder = builder.master(master)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
