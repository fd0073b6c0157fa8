"""A session with the settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Wall-clock times are UTC everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Join strategy, partition numbers and split skewed partitions are chosen from the sizes seen at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM leaves methods above 8000 bytes interpreted, so wide scoring stages run faster split up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Pages are large rows: bound what a Python worker holds at once.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    # Checkpoints go once nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Sessions of activity are merged before the shuffle.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build(app: str, **extra: str) -> SparkSession:
    """The session of `app`; `extra` uses `__` for the dots of a setting's name."""
    builder = SparkSession.builder.appName(app)
    for name, value in (SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}).items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
