"""Event streams: windowed counts and sessions with watermarks, first rows by key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(events: DataFrame, late: str) -> DataFrame:
    """A stream gets its watermark (on an instant, so plain timestamps are read in the session's
    time zone); a table stays as it is."""
    if not events.isStreaming:
        return events
    return events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)


def tumbling_counts(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts and sums by window and type; works on a stream (append mode) and on a table."""
    seen = _timed(events, late)
    return (
        seen.groupBy(F.window("ts", width).alias("w"), "event_type")
        .agg(F.count("*").alias("event_count"), F.sum("value").alias("value_sum"))
        .select(F.col("w.start").alias("window_start"), "event_type", "event_count", "value_sum")
    )


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    """Events of a user at most ``gap`` apart are one session."""
    seen = _timed(events, late)
    return (
        seen.groupBy(F.session_window("ts", gap).alias("s"), "user_id")
        .agg(F.count("*").alias("event_count"))
        .select("user_id", F.col("s.start").alias("session_start"), "event_count")
    )


def first_seen(events: DataFrame, key: str, late: str = "1 day") -> DataFrame:
    """One row per key within the watermark: the stream form of an append log with restart."""
    return _timed(events, late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])
