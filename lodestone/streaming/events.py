"""Structured Streaming over the event log: watermarked hourly counts and content-hash history of arriving rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def hourly_counts(spark: SparkSession, path: str, late: str = "2 hours") -> DataFrame:
    schema = spark.read.parquet(path).schema
    events = spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    return events.withWatermark("ts", late).groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
