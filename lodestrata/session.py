"""A session with the settings that the operators expect."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "lodestrata", master: str | None = None, **conf: str) -> SparkSession:
    """UTC, ANSI, adaptive execution with skew joins; cluster sizes are left to the deployment."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
    }
    for k, v in (settings | conf).items():
        b = b.config(k, v)
    return b.getOrCreate()
