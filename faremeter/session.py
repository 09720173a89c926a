"""Session defaults for tests, the benchmark and small scripts.

On a cluster the session comes from the submitter; nothing in the library depends on these settings.
"""
from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = 8, app: str = "faremeter", **extra: str) -> SparkSession:
    """A local session with adaptive execution on and the web page off."""
    extra.setdefault("spark.checkpoint.dir", tempfile.mkdtemp(prefix="faremeter-"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
