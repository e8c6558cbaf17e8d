"""Structured Streaming forms of the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def session_counts(events: DataFrame, keys: list[str], time: str, gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of each key separated by `gap`, for batch and stream alike: keys, start, end, n.

    On a stream rows later than the watermark are dropped; null keys form a group, null times are left out.
    """
    x = events.where(F.col(time).isNotNull())
    if events.isStreaming:
        x = x.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    s = x.groupBy(*keys, F.session_window(time, gap).alias("w")).agg(F.count("*").alias("n"), F.max(time).alias("last"))
    return s.select(*keys, F.col("w.start").alias("start"), F.col("last").alias("end"), "n")


def windowed_counts(events: DataFrame, key: str, time: str, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Rows per key and time window, tumbling or sliding."""
    x = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late) if events.isStreaming else events
    w = F.window(time, size, slide) if slide else F.window(time, size)
    return x.groupBy(key, w.alias("w")).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def session_sink(table, stream: str = "stream"):
    """A foreachBatch function that merges each micro-batch into a SessionTable once, also if it is delivered again.

    stream: the stream's name; one that starts anew with another checkpoint needs another.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch, batch_id, stream)

    return merge
