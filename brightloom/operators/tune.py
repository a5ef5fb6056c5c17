"""Choosing parameters: held-out error, folds, grids, curves and elbows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.param import Param
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightloom.session import scratch_path


def _tree_nodes(model, spark: SparkSession) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Depth, prediction and parent of every node of a tree model, parents first, and the nodes that are leaves, from the left.

    The model is saved and its nodes are read as a table, numbered in the order in which a walk from the left meets
    them: asking the model for one node after the other takes a call to the JVM for each.
    """
    path = scratch_path(spark, "tree")
    model.write().save(path)
    rows = spark.read.parquet(f"{path}/data").select("id", "prediction", "leftChild", "rightChild").orderBy("id").toPandas()
    left, right = rows["leftChild"].to_numpy(), rows["rightChild"].to_numpy()
    depth, parent = np.zeros(len(rows), int), np.full(len(rows), -1)
    level = np.flatnonzero(rows["id"] == 0)
    while len(level := level[left[level] >= 0]):
        for child in (left[level], right[level]):
            depth[child], parent[child] = depth[level] + 1, level
        level = np.concatenate([left[level], right[level]])
    return depth, rows["prediction"].to_numpy(float), parent, np.flatnonzero(left < 0)


def _errors_by_depth(model, parts: Sequence[DataFrame], label: str) -> list[np.ndarray]:
    """Share of wrong rows of each part, for a tree cut off at each depth from 0 to its own.

    A node above the cut predicts what it held when it was split. Rows are counted by leaf and label in one
    pass; the rest is worked out on the nodes, all counts climbing towards the root together.
    """
    model.setLeafCol("_leaf")
    depth, prediction, parent, leaves = _tree_nodes(model, parts[0].sparkSession)
    deepest, errors = int(depth.max()), []
    for df in parts:
        counts = model.transform(df).groupBy("_leaf", F.col(label).alias("_own")).agg(F.count("*").alias("n")).toPandas()
        at, own, n = leaves[counts["_leaf"].to_numpy(int)], counts["_own"].to_numpy(float), counts["n"].to_numpy(float)
        # What is wrong at a node is so at all cuts from its depth to the one above the node below.
        change, last, total = np.zeros(deepest + 2), np.full(len(at), deepest), n.sum()
        while len(at):
            wrong = prediction[at] != own
            np.add.at(change, depth[at][wrong], n[wrong])
            np.add.at(change, last[wrong] + 1, -n[wrong])
            last, at = depth[at] - 1, parent[at]
            own, n, last, at = (x[at >= 0] for x in (own, n, last, at))
        errors.append(np.cumsum(change)[:-1] / max(total, 1))
    return errors


def error_by_depth(model, train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Error of a grown tree cut off at every depth from 1 to its own: (depth, train, test)."""
    errors = _errors_by_depth(model, [train, test], label)
    rows = [(d, float(errors[0][d]), float(errors[1][d])) for d in range(min(1, len(errors[0]) - 1), len(errors[0]))]
    return train.sparkSession.createDataFrame(rows, "depth int, train double, test double")


def depth_search(
    df: DataFrame, label: str, fold: str, folds: int, depths: Sequence[int], fractions: Sequence[float] = (1.0,), seed: int = 7, parallelism: int = 4
) -> DataFrame:
    """Accuracy of trees by depth and share of the features tried at a split, on every fold: (depth, features, fold, train, validation).

    One tree is grown for each fold and share and cut at every depth, so the number of fits does not grow with
    the depths.
    """
    def scores(job: tuple[float, int, DataFrame, DataFrame]) -> list[tuple]:
        share, number, train, held = job
        grown = RandomForestClassifier(
            labelCol=label, numTrees=1, bootstrap=False, featureSubsetStrategy="all" if share >= 1 else str(share), maxDepth=max(depths), seed=seed)
        errors = _errors_by_depth(grown.fit(train).trees[0], [train, held], label)
        last = len(errors[0]) - 1
        return [(d, float(share), number, float(1 - errors[0][min(d, last)]), float(1 - errors[1][min(d, last)])) for d in depths]

    jobs = [(share, *part) for share in fractions for part in fold_parts(df, fold, folds)]
    with ThreadPoolExecutor(parallelism) as pool:
        rows = [row for found in pool.map(scores, jobs) for row in found]
    return df.sparkSession.createDataFrame(rows, "depth int, features double, fold int, train double, validation double")


def error_by_value(
    make: Callable[[object], Estimator], values: Sequence, train: DataFrame, test: DataFrame, evaluator: Evaluator
) -> DataFrame:
    """Score of one model per parameter value on train and test: (value, train, test)."""
    rows = []
    for v in values:
        model = make(v).fit(train)
        rows.append((float(v), evaluator.evaluate(model.transform(train)), evaluator.evaluate(model.transform(test))))
    return train.sparkSession.createDataFrame(rows, "value double, train double, test double")


def grid_search(
    estimator: Estimator, grid: Sequence[dict[Param, object]], evaluator: Evaluator, df: DataFrame, fold: str,
    folds: int, parallelism: int = 4, keep_models: bool = False,
) -> CrossValidatorModel:
    """Cross-validate every parameter set on the folds given by column ``fold``."""
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=list(grid), evaluator=evaluator, numFolds=folds, foldCol=fold,
        parallelism=parallelism, collectSubModels=keep_models,
    ).fit(df)


def _named(params: dict) -> str:
    return ", ".join(sorted(f"{p.name}={v}" for p, v in params.items()))


def search_table(found: CrossValidatorModel, df: DataFrame) -> DataFrame:
    """Mean and deviation of the fold scores of each parameter set: (params, mean, std)."""
    rows = [
        (_named(params), float(m), float(s))
        for params, m, s in zip(found.getEstimatorParamMaps(), found.avgMetrics, found.stdMetrics)]
    return df.sparkSession.createDataFrame(rows, "params string, mean double, std double")


def best_parameters(found: CrossValidatorModel) -> tuple[str, Model]:
    """The best parameter set and the model refitted with it on all rows."""
    scores = np.array(found.avgMetrics)
    at = scores.argmax() if found.getEvaluator().isLargerBetter() else scores.argmin()
    return _named(found.getEstimatorParamMaps()[int(at)]), found.bestModel


def fold_parts(df: DataFrame, fold: str, folds: int):
    """(number, train, test) for each fold."""
    for i in range(folds):
        yield i, df.filter(F.col(fold) != i), df.filter(F.col(fold) == i)


def fold_scores(estimator: Estimator, evaluator: Evaluator, df: DataFrame, fold: str, folds: int) -> DataFrame:
    """Score of each fold: (fold, score)."""
    rows = [
        (i, float(evaluator.evaluate(estimator.fit(train).transform(test))))
        for i, train, test in fold_parts(df, fold, folds)]
    return df.sparkSession.createDataFrame(rows, "fold int, score double")


def nested_search(
    estimator: Estimator, grid: Sequence[dict[Param, object]], evaluator: Evaluator, df: DataFrame,
    outer: str, outer_folds: int, inner: str, inner_folds: int,
) -> DataFrame:
    """Grid search inside each outer fold, scored on the part held out: (fold, params, score)."""
    rows = []
    for i, train, test in fold_parts(df, outer, outer_folds):
        found = grid_search(estimator, grid, evaluator, train, inner, inner_folds)
        params, model = best_parameters(found)
        rows.append((i, params, float(evaluator.evaluate(model.transform(test)))))
    return df.sparkSession.createDataFrame(rows, "fold int, params string, score double")


def validation_curve(
    estimator: Estimator, param: Param, values: Sequence, evaluator: Evaluator, df: DataFrame, fold: str, folds: int
) -> DataFrame:
    """Train and validation score of each value, averaged over folds: (value, train, validation)."""
    found = grid_search(estimator, [{param: v} for v in values], evaluator, df, fold, folds, keep_models=True)
    rows = []
    for at, v in enumerate(values):
        scores = [
            (evaluator.evaluate(found.subModels[i][at].transform(train)), found.avgMetrics[at])
            for i, train, _ in fold_parts(df, fold, folds)]
        rows.append((float(v), float(np.mean([s[0] for s in scores])), float(found.avgMetrics[at])))
    return df.sparkSession.createDataFrame(rows, "value double, train double, validation double")


def elbow(df: DataFrame, ks: Sequence[int], features: str = "features", seed: int = 7, tries: int = 3) -> DataFrame:
    """Clustering cost by number of clusters, the least of ``tries`` starts for each: (k, cost)."""
    df = df.select(features).persist()
    try:
        rows = []
        for k in ks:
            fits = [KMeans(k=k, seed=seed + i, featuresCol=features).fit(df) for i in range(tries)]
            rows.append((k, min(float(m.summary.trainingCost) for m in fits)))
    finally:
        df.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, cost double")
