"""Inputs that arrive over time: a stream of manifests, each path taken once, late repeats dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def arriving(spark: SparkSession, path: str, schema, event_time: str, late: str = "1 day") -> DataFrame:
    rows = spark.readStream.schema(schema).parquet(path)
    return rows.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, late)


def once(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.dropDuplicatesWithinWatermark(keys)


def counts(rows: DataFrame, event_time: str, key: str, every: str = "1 day") -> DataFrame:
    """Rows and mean value for each key and window."""
    return rows.groupBy(F.window(event_time, every), key).agg(F.count("*").alias("n"), F.avg("value").alias("mean"))


def run_available(rows: DataFrame, out: str, checkpoint: str) -> None:
    """Take what is there, append it to a Parquet folder and stop."""
    rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
