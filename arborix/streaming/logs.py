"""Append-only trigger logs as a stream (SNK-9)."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def status_rollup(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str = "ts timestamp, code string, status string, text string", lateness: str = "1 hour", window: str = "10 minutes", once: bool = True):
    """Counts by code, status and window of JSON lines in a folder, appended as Parquet when a window is closed by the watermark."""
    lines = spark.readStream.schema(schema).json(source).withWatermark("ts", lateness)
    counts = lines.groupBy(F.window("ts", window), "code", "status").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "code", "status", "n")
    writer = counts.writeStream.outputMode("append").format("parquet").option("path", target).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def append_log(spark: SparkSession, source: str, target: str, checkpoint: str, schema: str, key: list[str], time: str = "ts", lateness: str = "1 day"):
    """New lines appended to a JSON log, each key once within the lateness."""
    lines = spark.readStream.schema(schema).json(source).withWatermark(time, lateness).dropDuplicatesWithinWatermark(key)
    return lines.writeStream.outputMode("append").format("json").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
