"""A session with the settings that the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def get_session(name: str = "strandspark", **conf: str) -> SparkSession:
    """UTC times, adaptive plans with skewed joins split; conf overrides or adds settings.
    The cluster sets master, memory and spark.checkpoint.dir."""
    base = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    return SparkSession.builder.appName(name).config(map=base | conf).getOrCreate()
