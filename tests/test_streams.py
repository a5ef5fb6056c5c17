"""Streams against tables, and the rule for late rows."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from brightloom.session import scratch_path
from brightloom.streaming import files, windows


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("slide", [None, "30 minutes"])
def test_complete_mode_equals_the_table(spark, sf_dir, slide):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    path = scratch_path(spark, "replay")
    files.replay_table(events, path, 5)
    stream = windows.event_time(files.stream_files(spark, path, events.schema), "ts")
    counted = windows.window_counts(stream, "ts", "event_type", "60 minutes", slide, late_by="1 minute")
    want = windows.window_counts(windows.event_time(events, "ts"), "ts", "event_type", "60 minutes", slide)
    assert rows(files.drain_to_table(counted, "complete")) == rows(want)


def test_rows_behind_the_watermark_are_dropped_in_append_mode(spark):
    """Files in this order: noon, two for 14:00, then one row for the noon window.

    A batch drops rows by the watermark that the batch before it worked with, so the noon
    window is given out with the third file and closed to rows from the fourth on.
    """
    path = scratch_path(spark, "late")
    stamps = ["12:10:00", "14:10:00", "14:20:00", "12:20:00", "16:00:00"]
    for stamp in (f"2024-01-01 {t}" for t in stamps):
        df = spark.createDataFrame([(stamp, "a")], "t string, kind string").select(F.to_timestamp("t").alias("ts"), "kind")
        df.coalesce(1).write.mode("append").parquet(path)
        time.sleep(1.1)
    stream = files.stream_files(spark, path, df.schema)
    counted = windows.window_counts(stream, "ts", "kind", "60 minutes", late_by="1 minute")
    got = [(str(r["window_start"]), r["n"]) for r in files.drain_to_table(counted).orderBy("window_start").collect()]
    assert got == [("2024-01-01 12:00:00", 1), ("2024-01-01 14:00:00", 2)]
    complete = files.drain_to_table(counted, "complete")
    assert complete.agg(F.sum("n")).first()[0] == 5


def test_exploded_tags_count_as_keys(spark):
    df = spark.createDataFrame(
        [("2024-01-01 12:10:00", "x,Y"), ("2024-01-01 12:50:00", "x"), ("2024-01-01 12:50:00", None)], "t string, tags string")
    tagged = df.select(F.to_timestamp("t").alias("ts"), F.explode(F.split("tags", ",")).alias("tag"))
    got = {(r["key"], r["n"]) for r in windows.window_counts(tagged, "ts", "tag", "60 minutes").collect()}
    assert got == {("x", 2), ("Y", 1)}


def test_ordered_replay_cuts_ranges(spark):
    path = scratch_path(spark, "ordered")
    files.replay_table(spark.range(1000), path, 4, order=["id"])
    spans = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).agg(
        F.min("id").alias("a"), F.max("id").alias("b")).orderBy("a").collect()
    assert len(spans) == 4
    assert all(left["b"] < right["a"] for left, right in zip(spans, spans[1:]))


def test_replayed_queries_run_in_several_batches(spark, sf_dir):
    """State is carried from batch to batch, and files taken by size give batches too."""
    from brightloom.plans import streams

    counted = windows.window_counts(windows.event_time(streams.replayed_events(spark, sf_dir), "ts"), "ts", "event_type", "60 minutes", late_by="1 minute")
    path = scratch_path(spark, "counted")
    assert files.finish(files.table_sink(counted, path, "complete")) >= 3
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = scratch_path(spark, "replay")
    files.replay_table(events, folder, 6)
    stream = files.stream_files(spark, folder, events.schema, bytes_per_trigger=1)
    assert files.finish(files.table_sink(stream, scratch_path(spark, "copied"))) >= 3
