"""A session with the settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tidemark", **conf: str) -> SparkSession:
    """UTC, adaptive execution with skew joins, and the given settings; an existing session is reused."""
    build = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
    for k, v in conf.items():
        build = build.config(k.replace("__", "."), v)
    return build.getOrCreate()
