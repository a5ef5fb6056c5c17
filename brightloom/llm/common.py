"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from brightloom.session import scratch_path

#: A run of the six ASCII white-space characters; what lies between two runs is a word.
SPACE_RUN = "[ \\t-\\r]+"
WORD = "[^ \\t-\\r]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of words, without building them; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: lineage ends at the files."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_path = path
    return out


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Let batches of rows that go to Python hold at most ``rows``, where the session allows more.

    A batch lies several times in an executor's memory, and texts are long.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables from :func:`written` that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(df._written_path)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of plans that are no longer referenced."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def pieces(texts: Sequence[str | bytes | None], most: int = 1_000_000) -> Iterator[slice]:
    """Cut a batch into runs of neighbours of about ``most`` characters, at least one text each."""
    begin, held = 0, 0
    for i, text in enumerate(texts):
        held += len(text) if text else 0
        if held >= most:
            yield slice(begin, i + 1)
            begin, held = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
