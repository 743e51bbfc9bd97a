"""Session settings the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "tidewater", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI and adaptive execution; cluster settings are left to the cluster."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.ansi.enabled", "true").config("spark.sql.adaptive.enabled", "true").config("spark.sql.parquet.aggregatePushdown", "true")
    builder = builder.master(master) if master else builder
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
