"""Session settings the jobs are written for. On a cluster, pass the same keys to spark-submit."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where the aggregate behind it then needs one more shuffle.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoints go when the frames they belong to are no longer referenced.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, **extra: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName("vintner")
    settings = {
        **SETTINGS,
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
