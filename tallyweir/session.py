"""The Spark session that tests, bench and examples share."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def get_spark(app: str = "tallyweir", cpus: int | str | None = None, partitions: int | None = None) -> SparkSession:
    """A local session with the settings that the queries rely on (UTC, AQE)."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions or 8))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TALLYWEIR_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
