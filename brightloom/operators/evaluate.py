"""Scores of predictions: classes, rankings, numbers, rules and clusters."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from brightloom.operators.aggregates import metric_rows
from brightloom.operators.positions import with_running_sums


def confusion(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Counts by actual and predicted class, long form."""
    return df.groupBy(label, predicted).agg(F.count("*").alias("n"))


def binary_counts(df: DataFrame, label: str, predicted: str, positive=1) -> DataFrame:
    """True and false positives and negatives, one row. A missing label or prediction is not positive."""
    yes, said = (F.col(c).eqNullSafe(F.lit(positive)) for c in (label, predicted))
    return df.agg(
        F.count_if(yes & said).alias("tp"), F.count_if(~yes & said).alias("fp"),
        F.count_if(yes & ~said).alias("fn"), F.count_if(~yes & ~said).alias("tn"))


def accuracy(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Share of right predictions and of wrong ones (zero-one loss) among labelled rows; no prediction is wrong."""
    right = F.avg(F.when(F.col(label).isNotNull(), F.col(label).eqNullSafe(F.col(predicted)).cast("double")))
    return df.agg(right.alias("accuracy"), (1 - right).alias("zero_one_loss"))


def _ratio(part: Column, whole: Column) -> Column:
    """0 where there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def precision_recall(df: DataFrame, label: str, predicted: str, positive=1) -> DataFrame:
    """Precision, recall and F1 of the positive class, one row."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return binary_counts(df, label, predicted, positive).select(
        _ratio(tp, tp + fp).alias("precision"), _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"))


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted averages."""
    cells = confusion(df, label, predicted)
    right = F.sum(F.when(F.col("is_actual") & F.col("is_predicted"), F.col("n")).otherwise(0))

    def side(column: str, is_actual: bool, is_predicted: Column) -> Column:
        return F.struct(
            F.col(column).cast("string").alias("class"), F.lit(is_actual).alias("is_actual"),
            is_predicted.alias("is_predicted"))

    sides = cells.select("n", F.inline(F.array(
        side(label, True, F.col(label).eqNullSafe(F.col(predicted))), side(predicted, False, F.lit(True)))))
    per_class = sides.groupBy("class").agg(
        right.alias("tp"),
        F.sum(F.when(F.col("is_actual"), F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(~F.col("is_actual"), F.col("n")).otherwise(0)).alias("said"))
    tp = F.col("tp")
    scored = per_class.select(
        "class", _ratio(tp, F.col("said")).alias("precision"), _ratio(tp, F.col("support")).alias("recall"),
        _ratio(2 * tp, F.col("said") + F.col("support")).alias("f1"), "support")
    scores = ("precision", "recall", "f1")
    macro = scored.agg(
        F.lit("macro avg").alias("class"), *[F.avg(c).alias(c) for c in scores], F.sum("support").alias("support"))
    weighted = scored.agg(
        F.lit("weighted avg").alias("class"),
        *[_ratio(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(c) for c in scores],
        F.sum("support").alias("support"))
    return scored.unionByName(macro).unionByName(weighted)


def _ranked_scores(df: DataFrame, label: str, score: str, order: Column) -> DataFrame:
    """Positives and negatives per score value with running counts; equal scores share a row."""
    counted = df.groupBy(score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    return with_running_sums(counted, [order], {"pos_to": "pos", "neg_to": "neg"})


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, tp, fp, tpr, fpr) for each distinct score, largest first."""
    ranked = _ranked_scores(df, label, score, F.desc(score))
    totals = ranked.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    return ranked.select(
        F.col(score).alias("threshold"), F.col("pos_to").alias("tp"), F.col("neg_to").alias("fp"),
        _ratio(F.col("pos_to"), F.lit(totals["p"])).alias("tpr"),
        _ratio(F.col("neg_to"), F.lit(totals["n"])).alias("fpr"))


def area_under_roc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Share of positive and negative pairs ranked right, ties counting half; one row ``auc``."""
    ranked = _ranked_scores(df, label, score, F.asc(score))
    wide = "decimal(19,0)"
    below_twice = 2 * F.col("neg_to") - F.col("neg")
    wins_twice = F.sum(F.col("pos").cast(wide) * below_twice.cast(wide)).cast("double")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return ranked.agg(F.try_divide(wins_twice, 2 * pairs).alias("auc"))


def mean_squared_error(df: DataFrame, label: str, predicted: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(label) - F.col(predicted), 2)).alias("mse"))


def r_squared(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """One minus squared error over variance, in one pass over the rows that have both values."""
    error = F.pow(F.col(label) - F.col(predicted), 2)
    y = F.when(error.isNotNull(), F.col(label))
    return df.agg((1 - F.try_divide(F.sum(error), F.var_pop(y) * F.count(y))).alias("r2"))


def rule_quality(df: DataFrame, antecedent: Column, label: str, positive) -> DataFrame:
    """Coverage: share of rows meeting the antecedent. Accuracy: share of those that are positive."""
    met = F.count_if(antecedent)
    right = F.count_if(antecedent & (F.col(label) == F.lit(positive)))
    return df.agg(_ratio(met, F.count("*")).alias("coverage"), _ratio(right, met).alias("accuracy"))


def cluster_agreement(df: DataFrame, cluster: str, label: str) -> DataFrame:
    """Best class of each cluster (ties to the smallest class), its rows and the cluster's rows."""
    cells = df.groupBy(cluster, label).agg(F.count("*").alias("n"))
    return cells.groupBy(cluster).agg(
        F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("best_label"),
        F.max("n").alias("n_best"), F.sum("n").alias("n_rows"))


def compare_datasets(results: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """Metric rows with train and test side by side and their gap."""
    wide = metric_rows(results).groupBy("model", "metric").pivot("dataset", ["train", "test"]).agg(F.first("value"))
    return wide.withColumn("gap", F.col("train") - F.col("test"))


def with_residual(df: DataFrame, label: str, predicted: str, name: str = "residual") -> DataFrame:
    return df.withColumn(name, F.col(label) - F.col(predicted))
