"""Writers, and reuse of a result that is already on storage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def write_partitioned(df: DataFrame, path: str, *by: str) -> None:
    """Overwrite a Parquet table partitioned by ``by``.

    The rebalance hint gathers rows of one partition value into few files and lets
    adaptive execution split a value that holds many rows.
    """
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def write_csv(df: DataFrame, path: str, header: bool = True, sep: str = ",") -> None:
    """Overwrite a CSV table."""
    df.write.mode("overwrite").option("header", header).option("sep", sep).csv(path)


def write_lines(df: DataFrame, path: str) -> None:
    """Overwrite a text table from a single string column."""
    df.write.mode("overwrite").text(path)


def finished(spark: SparkSession, path: str) -> bool:
    """Whether a job has written the table at ``path`` to its end."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def reuse_or_compute(spark: SparkSession, path: str, compute: Callable[[], DataFrame]) -> DataFrame:
    """The table at ``path`` if finished, else compute it, save it there and read it back."""
    if not finished(spark, path):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def run_sql(df: DataFrame, statement: str, view: str) -> DataFrame:
    """Run SQL text over ``df`` under the name ``view``."""
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(statement)
