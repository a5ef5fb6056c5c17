"""Scoring a stream with a fitted model, and the running quality of the scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import DataFrame, functions as F

from brightloom.functions.numeric import round_to_class


def score(model: Model, df: DataFrame, keep: Sequence[str], top: int = 3) -> DataFrame:
    """Predictions rounded to classes 0..top; no state, so tables and streams work alike."""
    return model.transform(df).select(*keep, round_to_class(F.col("prediction"), top).alias("predicted"))


def running_confusion(scored: DataFrame, label: str) -> DataFrame:
    """Counts by actual and predicted class, kept up to date by the stream in complete mode."""
    return scored.groupBy(label, "predicted").agg(F.count("*").alias("n"))
