"""Linear regression by gradient descent, in batch and in mini-batches, and by least squares."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.operators.features import with_ones


def _moments(df: DataFrame, columns: Sequence[str], target: str) -> tuple[np.ndarray, np.ndarray, int]:
    """X'X, X'y and the row count, in one pass; their size depends on the columns only."""
    cells = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(columns) for b in columns[i:]]
    cells += [F.sum(F.col(a) * F.col(target)) for a in columns]
    row = df.agg(F.count("*"), *cells).first()
    k = len(columns)
    xx = np.zeros((k, k))
    upper = np.triu_indices(k)
    xx[upper] = row[1:1 + len(upper[0])]
    xx = xx + np.triu(xx, 1).T
    return xx, np.array(row[1 + len(upper[0]):], dtype=float), row[0]


def batch_gradient_descent(
    df: DataFrame, features: Sequence[str], target: str, rate: float = 0.01, rounds: int = 10_000
) -> list[float]:
    """Coefficients (intercept first) after ``rounds`` full-batch steps from zero.

    The gradient depends on the rows only through X'X and X'y, so the rows are read once
    and the steps run on a matrix of the size of the feature list.
    """
    xx, xy, n = _moments(with_ones(df.select(*features, target), "_one"), ["_one", *features], target)
    beta = np.zeros(len(xy))
    for _ in range(rounds):
        beta += rate / n * (xy - xx @ beta)
    return beta.tolist()


def linear_prediction(coefficients: Sequence[float], features: Sequence[str]) -> Column:
    """Intercept plus weighted features."""
    out = F.lit(coefficients[0])
    for b, c in zip(coefficients[1:], features, strict=True):
        out = out + F.lit(b) * F.col(c)
    return out


class Descent(NamedTuple):
    """Coefficients (intercept first), passes over the data, and whether the last step was below the tolerance."""

    coefficients: list[float]
    rounds: int
    converged: bool


def stochastic_gradient_descent(
    df: DataFrame, features: Sequence[str], target: str, rate: float = 0.01, tolerance: float = 1e-9, most_rounds: int = 200,
    batch: int = 32,
) -> Descent:
    """Least squares by variance-reduced mini-batch steps, from zero until a round moves nothing any more.

    A round sums the whole gradient over the partitions as one row, lets every partition take its own mini-batch
    steps corrected by that gradient, and averages the partitions by their rows (stochastic variance reduced
    gradient, Johnson and Zhang, NIPS 2013, on partitions). The corrections vanish at the solution, so
    the rate need not fall. Features should be scaled; rows with a null are left out; without rows all is 0.
    """
    names = [*features, target]
    rows = df.select(*[F.col(c).cast("double").alias(c) for c in names]).dropna().persist()
    beta, size = np.zeros(len(features) + 1), None
    try:
        for done in range(1, most_rounds + 1):
            error = F.col(target) - linear_prediction(beta.tolist(), features)
            sums = rows.agg(F.count("*"), F.sum(error), *[F.sum(error * F.col(c)) for c in features], F.sum(F.col(target) * F.col(target))).first()
            if not sums[0]:
                return Descent(beta.tolist(), done, True)
            full = np.array(sums[1:-1], dtype=float) / sums[0]
            size = size or max(np.sqrt(sums[-1] / sums[0]), 1e-300)
            start = beta.copy()

            def steps(pieces, start=start, full=full):
                moved, seen = start.copy(), 0
                for piece in pieces:
                    values = piece[names].to_numpy()
                    x = np.column_stack([np.ones(len(values)), values[:, :-1]])
                    for i in range(0, len(x), batch):
                        xb = x[i:i + batch]
                        # The error drops out: the two gradients of a batch differ by the way moved so far.
                        moved += rate * (full - xb.T @ (xb @ (moved - start)) / len(xb))
                    seen += len(x)
                if seen:
                    yield pd.DataFrame({"at": np.arange(len(moved)), "weight": moved * seen, "n": float(seen)})

            averaged = rows.mapInPandas(steps, "at bigint, weight double, n double").groupBy("at").agg(
                (F.sum("weight") / F.sum("n")).alias("b")).orderBy("at").collect()
            beta = np.array([r["b"] for r in averaged])
            if np.abs(beta - start).max() <= tolerance * size:
                return Descent(beta.tolist(), done, True)
    finally:
        rows.unpersist()
    return Descent(beta.tolist(), most_rounds, False)


class Moments(NamedTuple):
    """Sums over a set of rows: their number, of each column (the target last), and of each product of two."""

    n: int
    sums: np.ndarray
    products: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(*[a + b for a, b in zip(self, other)])

    def __sub__(self, other: Moments) -> Moments:
        return Moments(*[a - b for a, b in zip(self, other)])


def moments_by_fold(df: DataFrame, features: Sequence[str], target: str, fold: str | None = None) -> dict[object, Moments]:
    """The moments of the rows of each fold (one under None without ``fold``), in one pass; rows with a null are left out.

    Their size follows from the columns. Moments of several folds are the sums of theirs, so the rows outside a
    fold need no pass of their own.
    """
    names = [*features, target]
    columns = [F.col(c).cast("double").alias(c) for c in names]
    rows = df.select(*columns, (F.col(fold) if fold else F.lit(None).cast("int")).alias("_fold")).dropna(subset=names)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    found = {}
    for row in rows.groupBy("_fold").agg(
            F.count("*").alias("_n"), *[F.sum(c) for c in names], *[F.sum(F.col(a) * F.col(b)) for a, b in pairs]).collect():
        k = len(names)
        products = np.zeros((k, k))
        products[np.triu_indices(k)] = row[2 + k:]
        found[row["_fold"]] = Moments(row["_n"], np.array(row[2:2 + k], float), products + np.triu(products, 1).T)
    return found


class LinearFit(NamedTuple):
    intercept: float
    coefficients: np.ndarray

    def mse(self, m: Moments) -> float:
        """Mean squared error over the rows with these moments."""
        b = np.array([self.intercept, *self.coefficients, -1.0])
        whole = np.block([[np.array([[float(m.n)]]), m.sums[None, :]], [m.sums[:, None], m.products]])
        return float(max(b @ whole @ b, 0.0) / m.n)


def penalty_path(
    m: Moments, penalties: Sequence[float], kind: str = "lasso", tolerance: float = 1e-12, most_sweeps: int = 100_000
) -> dict[float, LinearFit]:
    """A fit on standardised features for each penalty, from the moments alone.

    ``lasso`` has least squares over ``2 n`` plus the penalty times the absolute coefficients, by coordinate
    descent from the largest penalty down, each fit beginning at the one before. ``ridge`` has least squares
    plus the penalty times the squared coefficients. Coefficients are given for the features as they are; the
    intercept is not penalised, and a constant feature has coefficient 0.
    """
    mean = m.sums / m.n
    cov = m.products / m.n - np.outer(mean, mean)
    spread = np.sqrt(np.clip(np.diag(cov)[:-1], 0, None))
    spread[spread <= 1e-12 * np.maximum(np.abs(mean[:-1]), 1e-300)] = 0.0
    live = np.flatnonzero(spread)
    gram = cov[np.ix_(live, live)] / np.outer(spread[live], spread[live])
    pull = cov[live, -1] / spread[live]
    out, beta = {}, np.zeros(len(live))
    for penalty in sorted(set(penalties), reverse=True):
        if kind == "ridge":
            beta = np.linalg.solve(m.n * gram + penalty * np.eye(len(live)), m.n * pull) if len(live) else beta
        else:
            scale = max(np.abs(pull).max(initial=0.0), 1e-300)
            for _ in range(most_sweeps):
                before = beta.copy()
                for j in range(len(live)):
                    rest = pull[j] - gram[j] @ beta + gram[j, j] * beta[j]
                    beta[j] = np.sign(rest) * max(abs(rest) - penalty, 0.0) / gram[j, j]
                if np.abs(beta - before).max(initial=0.0) <= tolerance * scale:
                    break
        coefficients = np.zeros(len(spread))
        coefficients[live] = beta / spread[live]
        out[penalty] = LinearFit(float(mean[-1] - coefficients @ mean[:-1]), coefficients)
    return out


def penalty_search(folds: Mapping[object, Moments], penalties: Sequence[float], kind: str = "lasso") -> list[tuple[float, object, float, float]]:
    """(penalty, fold, error on the other folds, error on the fold) for every penalty and fold, without reading a row.

    The moments of the rows to fit on are those of all rows less those of the fold.
    """
    whole = reduce(Moments.__add__, folds.values())
    found = []
    for fold, held in folds.items():
        rest = whole - held
        found += [(p, fold, fit.mse(rest), fit.mse(held)) for p, fit in penalty_path(rest, penalties, kind).items()]
    return found


def least_squares_table(df: DataFrame, features: Sequence[str], target: str, intercept: bool = False) -> DataFrame:
    """Coefficient, standard error, t and p value of each feature, with R² of the fit."""
    assembled = VectorAssembler(inputCols=list(features), outputCol="_x").transform(df)
    model = LinearRegression(
        featuresCol="_x", labelCol=target, solver="normal", fitIntercept=intercept, standardization=False).fit(assembled)
    s = model.summary
    names = [*features, "intercept"] if intercept else list(features)
    values = [*model.coefficients.tolist(), model.intercept] if intercept else model.coefficients.tolist()
    rows = [
        (name, float(b), float(se), float(t), float(p), float(s.r2))
        for name, b, se, t, p in zip(names, values, s.coefficientStandardErrors, s.tValues, s.pValues)]
    return df.sparkSession.createDataFrame(
        rows, "term string, coefficient double, std_error double, t double, p double, r2 double")
