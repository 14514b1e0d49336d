"""Session settings that hold for small tests and are overridden by a cluster's own."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # texts cost much more to read than files to open
    "spark.sql.files.openCostInBytes": "1m",
}


def local_session(cpus: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session on one machine, as tests and the bench use it."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName("textloom")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", partitions)
        .config("spark.driver.memory", memory)
        .getOrCreate()
    )
