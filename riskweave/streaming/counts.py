"""Event counts and runs over streams; the same functions take batch tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed(events: DataFrame, at: str, keys: list[str], value: str, every: str = "1 day", late: str = "2 days") -> DataFrame:
    """(keys, start, n, total) per window; events later than ``late`` are left out."""
    w = F.window(F.col(at), every)
    grouped = events.withWatermark(at, late).groupBy(w, *keys).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    return grouped.select(*keys, F.col("window.start").alias("start"), "n", "total")


def sessions(events: DataFrame, at: str, keys: list[str], gap: str = "30 minutes", late: str = "2 days") -> DataFrame:
    """(keys, start, end, n): events no further apart than ``gap``."""
    s = F.session_window(F.col(at), gap)
    grouped = events.withWatermark(at, late).groupBy(s, *keys).agg(F.count("*").alias("n"))
    return grouped.select(*keys, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def deduplicated(events: DataFrame, at: str, keys: list[str], late: str = "2 days") -> DataFrame:
    """Each event once while its watermark lasts."""
    return events.withWatermark(at, late).dropDuplicatesWithinWatermark(keys)


def upserts(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Write a counts stream as Parquet, one folder a batch; a replayed batch overwrites its own."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).foreachBatch(write).start()
