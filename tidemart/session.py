"""A session with the settings the engine is meant to run under."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tidemart", master: str | None = None, **conf: str) -> SparkSession:
    """Adaptive execution with skew-join splitting, UTC, Arrow; ``conf`` (dots as ``__``) overrides."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
