"""Feature preparation: learned on one table, applied to any."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline
from pyspark.ml.feature import PCA, Imputer, MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.functions import text
from brightloom.operators.positions import with_position
from brightloom.session import scratch_path


def learn_codes(df: DataFrame, column: str, by: str = "frequency") -> DataFrame:
    """Table (value, code): codes from 0 by falling frequency (ties by value) or by value.

    The codes stay a table, however many values there are.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("_n"))
    order = [F.desc("_n"), F.asc("value")] if by == "frequency" else [F.asc("value")]
    return with_position(counts, order, "code").select("value", "code")


def apply_codes(df: DataFrame, column: str, codes: DataFrame, name: str) -> DataFrame:
    """Add the code of each value; values not seen when learning get null."""
    return df.join(codes.select(F.col("value").alias(column), F.col("code").alias(name)), column, "left").select(
        *df.columns, name)


def indicator_columns(df: DataFrame, column: str, values: Sequence, drop_first: bool = False) -> DataFrame:
    """A 0/1 column for each given value."""
    kept = list(values)[1:] if drop_first else list(values)
    return df.select("*", *[
        F.when(F.col(column) == F.lit(v), 1).otherwise(0).alias(f"{column}_{v}") for v in kept])


@dataclass(frozen=True)
class Scaling:
    """Per column ``(x - shift) / scale``; a constant column is only shifted."""

    shift: dict[str, float]
    scale: dict[str, float]

    def column(self, name: str) -> Column:
        return (F.col(name) - F.lit(self.shift[name])) / F.lit(self.scale[name] or 1.0)

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.shift})


def _learn(df: DataFrame, columns: Sequence[str], shift, scale) -> Scaling:
    row = df.agg(*[shift(c).alias(f"{c}_a") for c in columns], *[scale(c).alias(f"{c}_b") for c in columns]).first()
    return Scaling({c: row[f"{c}_a"] for c in columns}, {c: row[f"{c}_b"] for c in columns})


def learn_standard(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Mean 0 and population deviation 1."""
    return _learn(df, columns, F.avg, F.stddev_pop)


def learn_min_max(df: DataFrame, columns: Sequence[str]) -> Scaling:
    """Range 0 to 1."""
    return _learn(df, columns, F.min, lambda c: F.max(c) - F.min(c))


def impute_means(df: DataFrame, columns: Sequence[str], learned_on: DataFrame | None = None) -> DataFrame:
    """Nulls to the column mean of ``learned_on``."""
    means = (learned_on or df).agg(*[F.avg(c).alias(c) for c in columns]).first()
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(means[c])) for c in columns})


def assemble(columns: Sequence[str], output: str = "features", invalid: str = "error") -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=invalid)


def impute_and_scale(columns: Sequence[str], output: str = "scaled") -> Pipeline:
    """Mean imputation, then scaling to 0..1, as one chain to fit."""
    filled = [f"{c}_filled" for c in columns]
    return Pipeline(stages=[
        Imputer(strategy="mean", inputCols=list(columns), outputCols=filled),
        VectorAssembler(inputCols=filled, outputCol=f"{output}_raw"),
        MinMaxScaler(inputCol=f"{output}_raw", outputCol=output),
    ])


def centred_pca(features: str, k: int, output: str) -> Pipeline:
    """Principal components of centred data."""
    return Pipeline(stages=[
        StandardScaler(withMean=True, withStd=False, inputCol=features, outputCol=f"{output}_centred"),
        PCA(k=k, inputCol=f"{output}_centred", outputCol=output),
    ])


def with_ones(df: DataFrame, name: str = "ones") -> DataFrame:
    """A leading column of ones."""
    return df.select(F.lit(1.0).alias(name), "*")


def _run_lengths(ordered: Column) -> Column:
    """(term, n) of every distinct value of a sorted array."""
    size = F.size(ordered)
    places = F.filter(
        F.transform(ordered, lambda x, i: F.when((i == 0) | (x != F.get(ordered, i - 1)), i)), lambda i: i.isNotNull())

    def entries(starts: Column) -> Column:
        return F.transform(starts, lambda at, j: F.struct(
            F.get(ordered, at).alias("term"), (F.coalesce(F.get(starts, j + 1), size) - at).cast("bigint").alias("n")))

    return text.once(places, entries)


def term_counts(df: DataFrame, key: str, column: str) -> DataFrame:
    """Cleaned words and word pairs of each text with their counts: (key, terms), ``terms`` an array of (term, n) by term.

    Counted inside the row, so nothing is shuffled; a text without words has an empty array. The result is
    written, so that the vocabulary and what is made with it share one cleaning of the texts.
    """
    both = text.once(text.clean_words(F.col(column)), lambda w: F.sort_array(F.concat(w, text.ngrams(w, 2))))
    counted = df.select(key, F.coalesce(text.once(both, _run_lengths), F.array().cast("array<struct<term:string,n:bigint>>")).alias("terms"))
    path = scratch_path(df.sparkSession, "terms")
    counted.write.parquet(path)
    return df.sparkSession.read.schema(counted.schema).parquet(path)


def top_terms(counts: DataFrame, size: int) -> DataFrame:
    """The ``size`` most frequent terms over all texts (ties by term), with their text counts."""
    totals = counts.select(F.inline("terms")).groupBy("term").agg(F.sum("n").alias("total"), F.count("*").alias("n_texts"))
    return totals.orderBy(F.desc("total"), "term").limit(size)


def tfidf(counts: DataFrame, vocabulary: DataFrame, n_texts: int) -> DataFrame:
    """``counts`` with ``terms`` as (term, weight): n * (ln((1 + texts) / (1 + texts with the term)) + 1), each text scaled to length 1.

    ``vocabulary`` comes from ``top_terms``, whose size the caller has set; its weights become part of the plan
    and are looked up inside the row.
    """
    rows = vocabulary.collect()
    if not rows:
        return counts.withColumn("terms", F.array().cast("array<struct<term:string,weight:double>>"))
    idf = F.create_map(*[
        x for r in rows for x in (F.lit(r["term"]), F.lit(math.log((1.0 + n_texts) / (1 + r["n_texts"])) + 1))])
    known = F.filter("terms", lambda x: x["term"].isin([r["term"] for r in rows]))
    raw = F.transform(known, lambda x: F.struct(x["term"].alias("term"), (x["n"] * idf[x["term"]]).alias("weight")))

    def scaled(weights: Column) -> Column:
        length = F.sqrt(F.aggregate(weights, F.lit(0.0), lambda s, x: s + x["weight"] * x["weight"]))
        return text.once(length, lambda n: F.transform(weights, lambda x: F.struct(x["term"].alias("term"), (x["weight"] / n).alias("weight"))))

    return counts.withColumn("terms", text.once(raw, scaled))


def weight_vectors(weighed: DataFrame, vocabulary: Sequence[str], output: str = "features") -> DataFrame:
    """``weighed`` with its terms as a vector over ``vocabulary``, for library models; terms that a text lacks are 0."""
    def vector(held: Column) -> Column:
        return F.transform(F.array(*[F.lit(t) for t in vocabulary]), lambda t: F.coalesce(F.try_element_at(held, t), F.lit(0.0)))

    return weighed.withColumn(output, array_to_vector(text.once(F.map_from_entries("terms"), vector)))
