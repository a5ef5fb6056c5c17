"""Readers for text lines, CSV in its several dialects, Parquet and in-memory rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from brightloom.operators.positions import with_position


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines of a file or folder, column ``value``."""
    return spark.read.text(path)


def drop_header_lines(lines: DataFrame, header: str) -> DataFrame:
    """Remove every line equal to ``header``; part files of a text table each carry one."""
    return lines.filter(F.col("value") != header)


def number_range(spark: SparkSession, start: int, stop: int, partitions: int | None = None) -> DataFrame:
    """Integers ``start`` to ``stop - 1`` in column ``id``, in a given number of partitions."""
    return spark.range(start, stop, 1, partitions)


def rows_to_table(spark: SparkSession, rows: Sequence, schema: T.StructType) -> DataFrame:
    """A table from a short list of rows written in the program."""
    return spark.createDataFrame(rows, schema)


def _pick(df: DataFrame, columns: Sequence[str] | None) -> DataFrame:
    return df.select(*columns) if columns else df


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str] | None = None, sep: str = ",") -> DataFrame:
    """CSV with a header, every column a string."""
    return _pick(spark.read.csv(path, header=True, inferSchema=False, sep=sep), columns)


def read_csv_typed(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    columns: Sequence[str] | None = None,
    drop_malformed: bool = False,
) -> DataFrame:
    """CSV with a header and an explicit schema, white space trimmed.

    With ``drop_malformed`` rows that do not fit the schema are left out; otherwise
    their unreadable fields are null.
    """
    reader = (
        spark.read.schema(schema)
        .option("header", True)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .option("mode", "DROPMALFORMED" if drop_malformed else "PERMISSIVE")
    )
    if drop_malformed:
        # Pruned columns are not parsed, so a bad value in one of them would go unnoticed.
        reader = reader.option("columnPruning", False)
    return _pick(reader.csv(path), columns)


def read_csv_named(
    spark: SparkSession, path: str, names: str, columns: Sequence[str] | None = None
) -> DataFrame:
    """CSV without a header; ``names`` is a comma-separated list of column names."""
    return _pick(spark.read.csv(path, header=False).toDF(*[n.strip() for n in names.split(",")]), columns)


def read_csv_inferred(spark: SparkSession, path: str, index_column: str | None = None) -> DataFrame:
    """CSV with inferred types, for exploration; the stored row index is left out."""
    df = spark.read.csv(path, header=True, inferSchema=True, ignoreLeadingWhiteSpace=True)
    return df.drop(index_column) if index_column else df


def read_tagged(
    paths: Mapping[str, str], read: Callable[[str], DataFrame], tag_column: str = "split"
) -> DataFrame:
    """Read several files with one reader, tag each row with its origin and stack them."""
    parts = [read(path).withColumn(tag_column, F.lit(tag)) for tag, path in paths.items()]
    return reduce(DataFrame.unionByName, parts)


def split_lines(
    lines: DataFrame, names: Sequence[str], sep: str = "\t", index_first: bool = False
) -> DataFrame:
    """Delimited lines (column ``value``) to string columns; ``index_first`` skips a leading index."""
    fields = F.split("value", sep)
    skip = 1 if index_first else 0
    return lines.select(*[F.get(fields, F.lit(i + skip)).alias(n) for i, n in enumerate(names)])


def block_to_lines(spark: SparkSession, block: str) -> DataFrame:
    """The non-empty lines of a text block written in the program, column ``value``."""
    return spark.createDataFrame([(line,) for line in block.splitlines() if line.strip()], "value string")


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give untyped columns the names and types of ``schema``, by position."""
    casts = [
        F.col(f"`{old}`").cast(field.dataType).alias(field.name)
        for old, field in zip(df.columns, schema.fields, strict=True)
    ]
    return df.select(*casts)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def enumerate_values(df: DataFrame, column: str, index: str = "index", value: str = "id") -> DataFrame:
    """Distinct values of a column with consecutive numbers from 0 in value order."""
    return with_position(df.select(F.col(column).alias(value)).distinct(), [value], index).select(index, value)
