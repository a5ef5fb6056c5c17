"""Streaming: windowed counts, watermarks, replay, sinks and scoring."""

from __future__ import annotations

import uuid

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import functions as F

from brightloom.plans.column_operations import events_k
from brightloom.plans.registry import query, table
from brightloom.session import scratch_path
from brightloom.streaming import files, scoring, windows


def counts_sql(slide_minutes: int = 60, extra: str = "") -> str:
    """Rows per window and type; a 60-minute window starts every ``slide_minutes``."""
    starts = " UNION ALL ".join(
        f"SELECT time_bucket(INTERVAL {slide_minutes} MINUTE, ts) - INTERVAL {back} MINUTE AS window_start, event_type, ts FROM events"
        for back in range(0, 60, slide_minutes))
    return f"""SELECT window_start, window_start + INTERVAL 60 MINUTE AS window_end, event_type AS key, count(*) AS n
        FROM ({starts}) GROUP BY window_start, event_type {extra}"""


def events_stream(spark, sf_dir):
    """The events file itself as a stream, read in one trigger."""
    schema = table(spark, sf_dir, "events").schema
    return files.stream_files(spark, sf_dir, schema, files_per_trigger=None, name_filter="events.parquet")


BATCHES = 4


def replayed_events(spark, sf_dir, fmt: str = "parquet"):
    """Events written as files, one for each piece of the scan and four at least, and streamed in four batches."""
    events = table(spark, sf_dir, "events")
    path = scratch_path(spark, "replay")
    n = max(BATCHES, events.rdd.getNumPartitions())
    files.replay_table(events, path, files=n, fmt=fmt)
    return files.stream_files(spark, path, events.schema, fmt=fmt, files_per_trigger=-(-n // BATCHES))


@query("t01_tumbling_window_count", sql=counts_sql(extra="HAVING count(*) > 2"))
def tumbling(spark, sf_dir):
    return windows.window_counts(table(spark, sf_dir, "events"), "ts", "event_type", "60 minutes", more_than=2)


@query("t02_sliding_window_count", sql=counts_sql(30))
def sliding(spark, sf_dir):
    return windows.window_counts(table(spark, sf_dir, "events"), "ts", "event_type", "60 minutes", "30 minutes")


@query("t01_exploded_tag_count", sql=f"""
    WITH tags AS (SELECT ts, unnest(string_split(event_type || CASE WHEN value > 100 THEN ',high' ELSE '' END, ',')) AS key FROM events)
    SELECT time_bucket(INTERVAL 60 MINUTE, ts) AS window_start, time_bucket(INTERVAL 60 MINUTE, ts) + INTERVAL 60 MINUTE AS window_end,
        upper(key) AS key, count(*) AS n FROM tags GROUP BY ALL HAVING count(*) > 2""")
def exploded_tags(spark, sf_dir):
    """Each entry of a list of tags counts in the window of its row; the list comes as a stream, in several batches."""
    listed = F.concat("event_type", F.when(F.col("value") > 100, ",high").otherwise(""))
    stream = replayed_events(spark, sf_dir).select("ts", F.explode(F.split(listed, ",")).alias("tag"))
    counted = windows.window_counts(windows.event_time(stream, "ts"), "ts", F.upper("tag"), "60 minutes", more_than=2)
    return files.drain_to_table(counted, mode="complete")


CLOSED_SQL = f"SELECT * FROM ({counts_sql()}) WHERE window_end <= (SELECT max(ts) - INTERVAL 1 MINUTE FROM events)"


@query("t03_watermark_append", sql=CLOSED_SQL)
def watermark_append(spark, sf_dir):
    """Append mode gives a window once the watermark, one minute behind the newest event, has passed it."""
    stream = windows.event_time(events_stream(spark, sf_dir), "ts")
    return files.drain_to_table(windows.window_counts(stream, "ts", "event_type", "60 minutes", late_by="1 minute"))


@query("t04_late_rows_complete_mode", sql=counts_sql())
def late_rows_complete(spark, sf_dir):
    """Complete mode keeps all state: with files in any order no late row is lost to the watermark."""
    stream = windows.event_time(replayed_events(spark, sf_dir), "ts")
    counted = windows.window_counts(stream, "ts", "event_type", "60 minutes", late_by="1 minute")
    return files.drain_to_table(counted, mode="complete")


@query("t05_replay_table", sql="SELECT event_id, user_id, event_type, value FROM events")
def replay(spark, sf_dir):
    """Every row of the table arrives once."""
    return files.drain_to_table(replayed_events(spark, sf_dir).select("event_id", "user_id", "event_type", "value"))


SENSOR = ["hour", "weekday", "k"]


def sensor_rows(df):
    """Events as sensor readings with an occupancy class 0..3 to predict."""
    level = F.when(F.hour("ts") < 6, 0).when(F.hour("ts") < 12, 1).when(F.hour("ts") < 18, 2).otherwise(3)
    return df.select(
        "event_id", F.hour("ts").alias("hour"), F.dayofweek("ts").alias("weekday"), events_k().alias("k"),
        level.cast("bigint").alias("occupancy"))


def sensor_model(spark, sf_dir):
    forest = RandomForestRegressor(labelCol="occupancy", numTrees=100, maxDepth=15, seed=7)
    return Pipeline(stages=[VectorAssembler(inputCols=SENSOR, outputCol="features"), forest]).fit(
        sensor_rows(table(spark, sf_dir, "events")))


@query("t06_score_stream")
def score_stream(spark, sf_dir):
    stream = sensor_rows(replayed_events(spark, sf_dir))
    return files.drain_to_table(scoring.score(sensor_model(spark, sf_dir), stream, ["event_id", "occupancy"]))


LINE_SQL = """
    f AS (SELECT regr_slope(o, h) AS b, regr_intercept(o, h) AS a FROM (SELECT hour(ts) AS h, hour(ts) // 6 AS o FROM events)),
    scored AS (SELECT event_id, CAST(hour(ts) // 6 AS BIGINT) AS occupancy, a + b * hour(ts) AS x FROM events, f),
    classes AS (SELECT event_id, occupancy, CAST(CASE WHEN x < 0.5 THEN 0 WHEN x < 1.5 THEN 1 WHEN x < 2.5 THEN 2 ELSE 3 END AS BIGINT) AS predicted FROM scored)"""


def sensor_line(spark, sf_dir):
    """Occupancy by a straight line on the hour."""
    rows = sensor_rows(table(spark, sf_dir, "events"))
    return Pipeline(stages=[
        VectorAssembler(inputCols=["hour"], outputCol="features"), LinearRegression(labelCol="occupancy", solver="normal")]).fit(rows)


@query("t06_score_stream_by_line", sql=f"WITH {LINE_SQL} SELECT event_id, occupancy, predicted FROM classes")
def score_stream_by_line(spark, sf_dir):
    stream = sensor_rows(replayed_events(spark, sf_dir))
    return files.drain_to_table(scoring.score(sensor_line(spark, sf_dir), stream, ["event_id", "occupancy"]))


@query("t07_running_confusion_by_line", sql=f"WITH {LINE_SQL} SELECT occupancy, predicted, count(*) AS n FROM classes GROUP BY occupancy, predicted")
def running_confusion_by_line(spark, sf_dir):
    """Counts carried on over the batches of the stream."""
    scored = scoring.score(sensor_line(spark, sf_dir), sensor_rows(replayed_events(spark, sf_dir)), ["occupancy"])
    return files.drain_to_table(scoring.running_confusion(scored, "occupancy"), mode="complete")


@query("t07_running_confusion")
def running_confusion(spark, sf_dir):
    stream = sensor_rows(replayed_events(spark, sf_dir))
    scored = scoring.score(sensor_model(spark, sf_dir), stream, ["occupancy"])
    return files.drain_to_table(scoring.running_confusion(scored, "occupancy"), mode="complete")


@query("t08_processing_time_trigger", sql=counts_sql())
def processing_time(spark, sf_dir):
    """A timed trigger keeps running, so it is stopped once the files present are done."""
    counted = windows.window_counts(events_stream(spark, sf_dir), "ts", "event_type", "60 minutes")
    path = scratch_path(spark, "timed")
    stream = files.table_sink(counted, path, mode="complete", every="1 second")
    try:
        stream.processAllAvailable()
    finally:
        stream.stop()
    return files.newest_batch(spark, path)


@query("s17_file_stream", sql="SELECT event_id, event_type, value FROM events")
def file_stream(spark, sf_dir):
    """CSV files with a fixed schema."""
    return files.drain_to_table(
        replayed_events(spark, sf_dir, fmt="csv").select("event_id", "event_type", "value"))


@query("s18_memory_sink_complete", sql=counts_sql())
def memory_sink_complete(spark, sf_dir):
    """The result has one row per hour and type, whatever the number of events."""
    name = f"hourly_{uuid.uuid4().hex}"
    counted = windows.window_counts(events_stream(spark, sf_dir), "ts", "event_type", "60 minutes")
    files.finish(files.memory_sink(counted, name, "complete"))
    return spark.table(name)


@query("s19_memory_sink_append", sql=CLOSED_SQL)
def memory_sink_append(spark, sf_dir):
    """Closed windows only, one row per hour and type; per-event results go to a table sink instead."""
    name = f"closed_{uuid.uuid4().hex}"
    stream = windows.event_time(events_stream(spark, sf_dir), "ts")
    counted = windows.window_counts(stream, "ts", "event_type", "60 minutes", late_by="1 minute")
    files.finish(files.memory_sink(counted, name, "append"))
    return spark.table(name)
