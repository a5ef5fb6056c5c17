"""File streams: sources, sinks and the replay of a table as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, types as T

from brightloom.session import scratch_path


def stream_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
    files_per_trigger: int | None = 1, name_filter: str | None = None, bytes_per_trigger: int | None = None,
) -> DataFrame:
    """A stream over the files of a folder, cut into batches by number of files, or by their bytes.

    With neither one batch takes all files present.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    elif files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def replay_table(
    df: DataFrame, path: str, files: int | None = None, order: Sequence[str | Column] = (), fmt: str = "parquet",
) -> None:
    """Write a table as files to be streamed; with ``order`` each file holds one range of it.

    Without ``files`` their number follows from the partitions of the table, or of the range sort.
    """
    count = [files] if files else []
    if order:
        df = df.repartitionByRange(*count, *order)
    elif files:
        df = df.repartition(files)
    df.write.mode("overwrite").format(fmt).option("header", True).save(path)


def _trigger(writer, every: str | None):
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def memory_sink(df: DataFrame, name: str, mode: str = "complete", every: str | None = None):
    """Start a stream into an in-memory table ``name``, for results known to be small.

    Without ``every`` (such as "10 seconds") the stream ends when the files present are read.
    """
    writer = df.writeStream.outputMode(mode).format("memory").queryName(name)
    return _trigger(writer.option("checkpointLocation", scratch_path(df.sparkSession, "stream-state")), every).start()


def table_sink(df: DataFrame, path: str, mode: str = "append", every: str | None = None):
    """Start a stream into a Parquet table; rows go from the tasks to storage.

    Append mode adds the rows of each batch once. Complete mode writes each batch's
    whole result to a folder of its own (``batch=N``) and then removes older ones but the last before it.
    """
    state = scratch_path(df.sparkSession, "stream-state")
    if mode == "append":
        writer = df.writeStream.outputMode("append").format("parquet").option("path", path)
    else:
        def save(batch: DataFrame, number: int) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/batch={number}")
            for old, place in _batches(batch.sparkSession, path).items():
                if old < number - 1:
                    place.getFileSystem(batch.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(place, True)

        writer = df.writeStream.outputMode(mode).foreachBatch(save)
    return _trigger(writer.option("checkpointLocation", state), every).start()


def finish(stream, seconds: int | None = None) -> int:
    """Wait until a stream that ends by itself has read all its input; the number of its batches.

    ``seconds`` bounds the wait if given.
    """
    if seconds is None:
        stream.awaitTermination()
    elif not stream.awaitTermination(seconds):
        stream.stop()
        raise TimeoutError("the stream did not end in time")
    return stream.lastProgress["batchId"] + 1 if stream.lastProgress else 0


def _batches(spark: SparkSession, path: str) -> dict[int, object]:
    """The batch folders below ``path`` by number; none if the folder is not there."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    store = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(folder):
        return {}
    found = {entry.getPath().getName(): entry.getPath() for entry in store.listStatus(folder)}
    return {int(name.removeprefix("batch=")): place for name, place in found.items() if name.startswith("batch=")}


def newest_batch(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The result that a complete-mode ``table_sink`` wrote last; with ``schema`` an empty table where there is none."""
    found = _batches(spark, path)
    if not found and schema is not None:
        return spark.createDataFrame([], schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{path}/batch={max(found)}")


def drain_to_table(df: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over the files present into a fresh table and read the result."""
    spark = df.sparkSession
    path = scratch_path(spark, "stream-result")
    finish(table_sink(df, path, mode))
    return spark.read.schema(df.schema).parquet(path) if mode == "append" else newest_batch(spark, path, df.schema)
