"""Spark session for local runs; on a cluster the session comes from outside."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", memory: str = "8g", shuffle_partitions: int | None = None) -> SparkSession:
    """Local session with adaptive execution; shuffle partitions match the cores unless given."""
    partitions = shuffle_partitions or (cores if isinstance(cores, int) else 8)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tallyfold")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
