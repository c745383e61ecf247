"""Session defaults: UTC, adaptive execution, Arrow exchange."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: str = "8", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster the submitter's settings hold."""
    conf = DEFAULTS | {"spark.master": f"local[{cpus}]", "spark.driver.memory": "12g", "spark.sql.shuffle.partitions": "8"} | extra
    spark = SparkSession.builder.config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
