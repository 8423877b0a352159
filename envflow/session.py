"""A session with the settings that the engine's results rely on: UTC, ANSI, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "envflow", master: str | None = None, partitions: int | None = None, **conf: str) -> SparkSession:
    """A builder with the engine's settings; a cluster's own master and partition count stay unless given."""
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true"} | conf
    builder = SparkSession.builder.appName(app)
    builder = builder.master(master) if master else builder
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    return builder.config(map=settings).getOrCreate()
