"""Windowed counts that serve tables and streams alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def event_time(df: DataFrame, time: str) -> DataFrame:
    """Watermarks need a timestamp with time zone; the session zone gives the reading."""
    return df.withColumn(time, F.col(time).cast("timestamp"))


def window_counts(
    df: DataFrame, time: str, key: str | Column, length: str, slide: str | None = None,
    more_than: int | None = None, late_by: str | None = None,
) -> DataFrame:
    """Rows per time window and key: (window_start, window_end, key, n).

    ``key`` may be a column expression, such as an exploded list of tags; rows without a
    key are left out. ``more_than`` keeps larger counts only. ``late_by`` sets the
    watermark, which matters to streams in append and update mode.
    """
    key = F.col(key) if isinstance(key, str) else key
    rows = df.select(F.col(time), key.alias("key")).filter(F.col("key").isNotNull())
    if late_by:
        rows = rows.withWatermark(time, late_by)
    window = F.window(time, length, slide) if slide else F.window(time, length)
    counted = rows.groupBy(window.alias("window"), "key").agg(F.count("*").alias("n"))
    if more_than is not None:
        counted = counted.filter(F.col("n") > more_than)
    return counted.select(
        F.col("window.start").cast("timestamp_ntz").alias("window_start"),
        F.col("window.end").cast("timestamp_ntz").alias("window_end"), "key", "n")
