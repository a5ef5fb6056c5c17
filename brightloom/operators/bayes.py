"""Naive Bayes from counts (categories), from moments (numbers) and from term weights (texts).

Scores are logarithms and posteriors are formed relative to the best class, so many attributes or rare values
do not underflow.
"""

from __future__ import annotations

import copy
import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.operators.aggregates import class_priors
from brightloom.operators.skew import salted_join

#: A value table of at most so many rows is broadcast.
BROADCAST_VALUES = 100_000
_NEVER = float("-inf")


def _log(p: float) -> float:
    return math.log(p) if p > 0 else _NEVER


def _posteriors(df: DataFrame, scores: Mapping, keep: Sequence[str]) -> DataFrame:
    """The best class by log score, with its posterior; ties go to the first class in order.

    Where no class is possible there is no prediction.
    """
    entries = F.array(*[
        F.struct(s.alias("score"), F.lit(-i).alias("at"), F.lit(c).alias("class")) for i, (c, s) in enumerate(scores.items())])
    scored = df.withColumn("_scores", entries).withColumn("_best", F.array_max("_scores"))
    best = F.col("_best.score")
    total = F.aggregate("_scores", F.lit(0.0), lambda sum_, x: sum_ + F.exp(x["score"] - best))
    possible = best > F.lit(_NEVER)
    return scored.select(
        *keep, F.when(possible, F.col("_best.class")).alias("predicted"), F.when(possible, 1.0 / total).alias("probability"))


class CategoricalBayes:
    """Class shares and, per attribute, the share of each value within each class.

    ``smoothing`` is added to every count; 0 gives plain shares.
    """

    def __init__(self, train: DataFrame, attributes: Sequence[str], label: str, smoothing: float = 0.0):
        self.attributes = list(attributes)
        # One row per class.
        rows = class_priors(train, label).orderBy(label).collect()
        self.priors = {r[label]: r["prior"] for r in rows}
        sizes = {r[label]: r["n"] for r in rows}
        self.tables, self.sizes, self.unseen = {}, {}, {}
        for a in self.attributes:
            counts = train.filter(F.col(a).isNotNull()).groupBy(a).agg(*[
                F.count_if(F.col(label) == F.lit(c)).alias(f"n{i}") for i, c in enumerate(self.priors)])
            n_values = self.sizes[a] = counts.count()
            share = {i: (F.col(f"n{i}") + smoothing) / (n + smoothing * n_values) for i, n in enumerate(sizes.values())}
            self.tables[a] = counts.select(F.col(a), *[
                F.when(x > 0, F.ln(x)).otherwise(_NEVER).alias(f"_{a}_{i}") for i, x in share.items()])
            self.unseen[a] = [_log(smoothing / (n + smoothing * n_values)) for n in sizes.values()]

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Class and posterior per row, one join per attribute.

        Value tables of up to ``BROADCAST_VALUES`` rows are broadcast. With longer ones the rows of hot values are
        dealt over tasks by the columns ``keep``, which should tell the rows apart.
        """
        joined = df
        for a, shares in self.tables.items():
            if self.sizes[a] <= BROADCAST_VALUES:
                joined = joined.join(F.broadcast(shares), a, "left")
            else:
                joined = salted_join(joined, shares, [a], keep, "left")
        scores: dict = {}
        for i, (c, prior) in enumerate(self.priors.items()):
            parts = [F.coalesce(F.col(f"_{a}_{i}"), F.lit(self.unseen[a][i])) for a in self.attributes]
            scores[c] = reduce(lambda x, y: x + y, parts, F.lit(_log(prior)))
        return _posteriors(joined, scores, keep)


class GaussianBayes:
    """Class shares and the mean and sample variance of each number within each class.

    A variance is at least ``floor`` times the variance of the column over all rows, so a class of one
    row or with equal values gives finite scores; a column that is constant throughout says nothing.
    """

    def __init__(self, train: DataFrame, attributes: Sequence[str], label: str, floor: float = 1e-9):
        self.attributes = list(attributes)
        moments = [f(a).alias(f"{a}_{name}") for a in attributes for name, f in (("m", F.avg), ("v", F.var_samp))]
        # One row per class, and one for the whole table.
        rows = train.groupBy(label).agg(F.count("*").alias("n"), *moments).orderBy(label).collect()
        whole = train.agg(*[F.var_pop(a).alias(a) for a in attributes]).first()
        total = sum(r["n"] for r in rows)
        self.priors = {r[label]: r["n"] / total for r in rows}
        least = {a: floor * whole[a] for a in attributes if whole[a]}
        self.moments = {
            r[label]: {a: (r[f"{a}_m"], max(r[f"{a}_v"] or 0.0, v)) for a, v in least.items() if r[f"{a}_m"] is not None} for r in rows}

    def _score(self, c) -> Column:
        parts = [
            -F.pow(F.col(a) - F.lit(m), 2) / (2 * v) - 0.5 * math.log(2 * math.pi * v) for a, (m, v) in self.moments[c].items()]
        return reduce(lambda x, y: x + y, parts, F.lit(_log(self.priors[c])))

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        return _posteriors(df, {c: self._score(c) for c in self.priors}, keep)


class MultinomialBayes:
    """Class shares and, within each class, the share of each term in the summed weights plus ``smoothing``.

    Texts are rows with an array ``terms`` of (term, weight). The sums are one row per class and term of the
    vocabulary; a text without any term has the class shares alone.
    """

    def __init__(self, train: DataFrame, label: str, vocabulary: Sequence[str], terms: str = "terms", smoothing: float = 1.0):
        self.terms, self.vocabulary = terms, list(vocabulary)
        rows = class_priors(train, label).orderBy(label).collect()
        self.priors = {r[label]: r["prior"] for r in rows}
        long = train.select(F.col(label).alias("label"), F.inline(terms).alias("term", "weight")).filter(F.col("term").isin(self.vocabulary))
        sums = long.groupBy("label", "term").agg(F.sum("weight").alias("s")).collect()  # classes times vocabulary
        self.held = {(r["label"], r["term"]): float(r["s"]) for r in sums}
        self._learn(smoothing)

    def _learn(self, smoothing: float) -> None:
        self.logs = {}
        for c in self.priors:
            own = [self.held.get((c, t), 0.0) + smoothing for t in self.vocabulary]
            total = sum(own)
            self.logs[c] = [_log(x / total) for x in own]

    def smoothed(self, smoothing: float) -> MultinomialBayes:
        """The model with another smoothing, from the same sums."""
        other = copy.copy(self)
        other._learn(smoothing)
        return other

    def predict(self, df: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Class and posterior per text, worked out inside the row."""
        entries = [x for i, t in enumerate(self.vocabulary) for x in (F.lit(t), F.array(*[F.lit(self.logs[c][i]) for c in self.priors]))]
        logs = F.create_map(*entries)
        known = F.filter(self.terms, lambda x: x["term"].isin(self.vocabulary))
        weighed = F.transform(known, lambda x: F.struct(x["weight"].alias("weight"), logs[x["term"]].alias("logs")))

        def score(at: int, prior: float) -> Column:
            return F.aggregate("_known", F.lit(_log(prior)), lambda s, x: s + x["weight"] * x["logs"][at])

        scores = {c: score(i, p) for i, (c, p) in enumerate(self.priors.items())}
        return _posteriors(df.withColumn("_known", weighed), scores, keep)

    def predict_smoothed(self, df: DataFrame, smoothings: Sequence[float], keep: Sequence[str]) -> DataFrame:
        """The class of each text by smoothing, a row for each: (keep, smoothing, predicted).

        The terms of a text are looked up once for all smoothings.
        """
        models, width = [self.smoothed(a) for a in smoothings], len(self.priors)
        entries = [
            x for i, t in enumerate(self.vocabulary)
            for x in (F.lit(t), F.array(*[F.lit(m.logs[c][i]) for m in models for c in self.priors]))]
        logs = F.create_map(*entries)
        known = F.filter(self.terms, lambda x: x["term"].isin(self.vocabulary))
        weighed = F.transform(known, lambda x: F.struct(x["weight"].alias("weight"), logs[x["term"]].alias("logs")))
        rows = df.withColumn("_known", weighed)

        def score(at: int, prior: float) -> Column:
            return F.aggregate("_known", F.lit(_log(prior)), lambda s, x: s + x["weight"] * x["logs"][at])

        found = []
        for m, a in enumerate(smoothings):
            scores = {c: score(m * width + i, p) for i, (c, p) in enumerate(self.priors.items())}
            # As in :func:`_posteriors`: ties go to the first class, and where no class is possible there is none.
            best = F.array_max(F.array(*[F.struct(s.alias("score"), F.lit(-i).alias("at"), F.lit(c).alias("class")) for i, (c, s) in enumerate(scores.items())]))
            found.append(F.struct(F.lit(float(a)).alias("smoothing"), F.when(best["score"] > F.lit(_NEVER), best["class"]).alias("predicted")))
        return rows.select(*keep, F.inline(F.array(*found)))


class MultinomialFolds:
    """Multinomial Bayes for every fold and smoothing at once: sums for each fold are taken in one pass, and what a
    model learns from is the whole less the folds held out.

    ``folds`` names the fold column, or an outer and an inner one for nested searches. The sums are one row for
    each combination of folds, class and term of the vocabulary.
    """

    def __init__(self, rows: DataFrame, label: str, vocabulary: Sequence[str], folds: Sequence[str], smoothings: Sequence[float], terms: str = "terms"):
        self.rows, self.label, self.terms, self.folds = rows, label, terms, list(folds)
        self.vocabulary, self.smoothings = list(vocabulary), list(smoothings)
        sizes = rows.groupBy(*folds, label).agg(F.count("*").alias("n")).collect()
        long = rows.select(*folds, F.col(label).alias("_label"), F.inline(terms).alias("term", "weight")).filter(F.col("term").isin(self.vocabulary))
        sums = long.groupBy(*folds, "_label", "term").agg(F.sum("weight").alias("s")).collect()
        self.classes = sorted({r[label] for r in sizes})
        self.values = [sorted({r[f] for r in sizes}) for f in folds]
        at = [{v: i for i, v in enumerate(values)} for values in [*self.values, self.classes, self.vocabulary]]
        k = len(self.folds)
        self.n = np.zeros([len(x) for x in at[:-1]])
        self.s = np.zeros([len(x) for x in at])
        for r in sizes:
            self.n[tuple(at[i][r[i]] for i in range(k + 1))] = r["n"]
        for r in sums:
            self.s[tuple(at[i][r[i]] for i in range(k + 2))] = r["s"]

    def _model(self, n: np.ndarray, s: np.ndarray) -> tuple[list[float], dict[str, list[float]]]:
        """Log shares of the classes, and of each term, for each smoothing and class in turn."""
        with np.errstate(divide="ignore"):
            priors = np.log(n / max(n.sum(), 1.0))
        logs = np.stack([np.log((s + a) / (s + a).sum(axis=1, keepdims=True)) for a in self.smoothings])
        return priors.tolist(), {t: logs[:, :, i].ravel().tolist() for i, t in enumerate(self.vocabulary)}

    def _scored(self, models: list[tuple], keys: Sequence[str], rows: DataFrame, condition: Column) -> DataFrame:
        """Right or wrong, by model and smoothing, for the rows that ``condition`` gives to each model."""
        spark, width = rows.sparkSession, len(self.classes)
        kinds = {k: dict(rows.dtypes)[f] for k, f in zip(("outer", "inner"), self.folds)}
        schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "priors array<double>, logs map<string, array<double>>"])
        table = spark.createDataFrame(models, schema)  # one row a model
        met = rows.join(F.broadcast(table), condition)
        known = F.filter(self.terms, lambda x: F.map_contains_key("logs", x["term"]))
        start = F.flatten(F.array(*[F.col("priors")] * len(self.smoothings)))
        scores = F.aggregate(known, start, lambda have, x: F.zip_with(have, F.col("logs")[x["term"]], lambda a, b: a + x["weight"] * b))
        best = []
        for i, a in enumerate(self.smoothings):
            entries = F.array(*[
                F.struct(F.col("_scores")[i * width + j].alias("score"), F.lit(-j).alias("at"), F.lit(c).alias("class")) for j, c in enumerate(self.classes)])
            best.append(F.struct(F.lit(float(a)).alias("smoothing"), (F.array_max(entries)["class"] == F.col(self.label)).cast("double").alias("right")))
        return met.withColumn("_scores", scores).select(*keys, *self.folds, F.inline(F.array(*best)))

    def scores(self) -> DataFrame:
        """Accuracy on each fold of the model learned on all others: (fold, smoothing, score)."""
        fold = self.folds[0]
        n, s = (x.reshape(len(self.values[0]), -1, *x.shape[len(self.folds):]).sum(axis=1) for x in (self.n, self.s))
        models = [(v, *self._model(n.sum(0) - n[i], s.sum(0) - s[i])) for i, v in enumerate(self.values[0])]
        right = self._scored(models, ["outer"], self.rows, F.col(fold) == F.col("outer"))
        return right.groupBy(F.col(fold).alias("fold"), "smoothing").agg(F.avg("right").alias("score"))

    def nested_scores(self) -> DataFrame:
        """Search inside each outer fold, scored on the part held out: (fold, smoothing, inner_score, score).

        The smoothing chosen has the best mean over the inner folds; ties go to the smaller one.
        """
        outer, inner = self.folds
        n, s = self.n.sum((0, 1)), self.s.sum((0, 1))
        models = []
        for i, o in enumerate(self.values[0]):
            for j, v in enumerate(self.values[1]):
                rest = [whole - part[i].sum(0) - part[:, j].sum(0) + part[i, j] for whole, part in ((n, self.n), (s, self.s))]
                models.append((o, v, *self._model(*rest)))
        condition = (F.col(inner) == F.col("inner")) & (F.col(outer) != F.col("outer"))
        right = self._scored(models, ["outer", "inner"], self.rows, condition)
        each = right.groupBy("outer", "inner", "smoothing").agg(F.avg("right").alias("score"))
        means = each.groupBy("outer", "smoothing").agg(F.round(F.avg("score"), 9).alias("inner_score"))
        order = F.struct(-F.col("inner_score"), F.col("smoothing"))
        best = means.groupBy(F.col("outer").alias("fold")).agg(
            F.min_by("smoothing", order).alias("smoothing"), F.min_by("inner_score", order).alias("inner_score"))
        return best.join(self.scores(), ["fold", "smoothing"])
