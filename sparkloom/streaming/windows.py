"""Windowed aggregates that run on a batch or, with a watermark, on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_counts(events: DataFrame, key: str, at: str, value: str, width: str, late: str = "1 hour", slide: str | None = None) -> DataFrame:
    """(key, start, n, mean) by windows of event time; start in seconds.

    On a stream, rows later than `late` are left out and a window is final once
    the watermark has passed it; state is a count and a sum for each open window.
    """
    timed = events.withColumn(at, F.col(at).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark(at, late)
    window = F.window(at, width, slide) if slide else F.window(at, width)
    out = timed.groupBy(key, window.alias("w")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
    return out.select(key, F.unix_timestamp(F.col("w.start")).alias("start"), "n", "mean")


def covered_bins(events: DataFrame, key: str, at: str, seconds: str, width: int, late: int = 3600, longest: int = 86_400) -> DataFrame:
    """(key, bin, n): interval_coverage() for events that last `seconds`, by explosion, so that it can follow a stream.

    On a stream a bin is a window of event time: its state goes, and in append mode it
    is final, once bins `late` + `longest` seconds further on have been seen.  That is when
    no event that lasts at most `longest` and comes at most `late` behind can cover it.
    """
    s = F.unix_timestamp(F.col(at).cast("timestamp"))
    a, b = F.floor(s / width) * width, F.floor((s + F.col(seconds)) / width) * width
    spread = events.where(b - a > 2 * width).select(key, F.explode(F.sequence((a + width).cast("long"), (b - width).cast("long"), F.lit(width).cast("long"))).alias("bin"))
    timed = spread.select(key, F.timestamp_seconds("bin").alias("__bin"))
    if events.isStreaming:
        timed = timed.withWatermark("__bin", f"{late + longest} seconds")
    out = timed.groupBy(key, F.window("__bin", f"{width} seconds").alias("w")).agg(F.count("*").alias("n"))
    return out.select(key, F.unix_timestamp(F.col("w.start")).alias("bin"), "n")
