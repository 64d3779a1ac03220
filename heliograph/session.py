"""A session with the settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str = "local[*]", name: str = "heliograph", **conf: str) -> SparkSession:
    """Adaptive execution, UTC, Arrow; keyword arguments are further settings with ``__`` for dots."""
    b = (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
