"""Evaluation and tuning."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from brightloom.operators import bayes, columns as cols, evaluate, linear, ranking, tune
from brightloom.operators.aggregates import metric_rows
from brightloom.plans.aggregation import HASH_SQL, SCORED_SQL, scored_documents
from brightloom.plans.column_operations import RETURNS_SQL, returns, rule_conditions
from brightloom.plans.models import (
    LINE_SPLIT_SQL, PENALTIES, PENALTY_SQL, TEXTS_SQL, labelled_texts, multinomial_sql, priced_lines, shrunk, vectors,
)
from brightloom.plans.registry import query, table
from brightloom.session import checkpointed

C_SQL = f"""c AS (SELECT count(*) FILTER (quality = 1 AND predicted = 1) AS tp, count(*) FILTER (quality = 0 AND predicted = 1) AS fp,
    count(*) FILTER (quality = 1 AND predicted = 0) AS fn, count(*) FILTER (quality = 0 AND predicted = 0) AS tn FROM {SCORED_SQL})"""


@query("e01_confusion_matrix", sql=f"SELECT quality, predicted, count(*) AS n FROM {SCORED_SQL} GROUP BY quality, predicted")
def confusion_matrix(spark, sf_dir):
    return evaluate.confusion(scored_documents(spark, sf_dir), "quality", "predicted")


@query("e01_binary_counts", sql=f"WITH {C_SQL} SELECT * FROM c")
def binary_counts(spark, sf_dir):
    return evaluate.binary_counts(scored_documents(spark, sf_dir), "quality", "predicted")


@query("e02_accuracy", sql=f"SELECT round(avg(CAST(quality = predicted AS INTEGER)), 9) AS accuracy FROM {SCORED_SQL}")
def accuracy(spark, sf_dir):
    return evaluate.accuracy(scored_documents(spark, sf_dir), "quality", "predicted").select(
        F.round("accuracy", 9).alias("accuracy"))


@query("e03_zero_one_loss", sql=f"SELECT round(avg(CAST(quality <> predicted AS INTEGER)), 9) AS loss FROM {SCORED_SQL}")
def zero_one_loss(spark, sf_dir):
    return evaluate.accuracy(scored_documents(spark, sf_dir), "quality", "predicted").select(
        F.round("zero_one_loss", 9).alias("loss"))


@query("e04_precision_recall_f1", sql=f"""
    WITH {C_SQL} SELECT round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall,
                        round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM c""")
def precision_recall(spark, sf_dir):
    out = evaluate.precision_recall(scored_documents(spark, sf_dir), "quality", "predicted")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query("e05_class_report", sql=f"""
    WITH {C_SQL}, r AS (
        SELECT '1' AS class, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS support FROM c
        UNION ALL SELECT '0', tn / (tn + fn), tn / (tn + fp), 2 * tn / (2 * tn + fp + fn), tn + fp FROM c),
    a AS (SELECT * FROM r UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM r
        UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                         sum(f1 * support) / sum(support), sum(support) FROM r)
    SELECT class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, CAST(support AS BIGINT) AS support FROM a""")
def class_report(spark, sf_dir):
    out = evaluate.class_report(scored_documents(spark, sf_dir), "quality", "predicted")
    return out.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1")})


@query("e06_roc_points", sql=f"""
    SELECT n_chars AS threshold, round(sum(sum(quality)) OVER w / (SELECT sum(quality) FROM {SCORED_SQL}), 9) AS tpr,
           round(sum(sum(1 - quality)) OVER w / (SELECT sum(1 - quality) FROM {SCORED_SQL}), 9) AS fpr
    FROM {SCORED_SQL} GROUP BY n_chars WINDOW w AS (ORDER BY n_chars DESC)""")
def roc_points(spark, sf_dir):
    return evaluate.roc_points(scored_documents(spark, sf_dir), "quality", "n_chars").select(
        "threshold", F.round("tpr", 9).alias("tpr"), F.round("fpr", 9).alias("fpr"))


@query("e07_area_under_roc", sql=f"""
    SELECT round(avg(CASE WHEN p.n_chars > n.n_chars THEN 1.0 WHEN p.n_chars = n.n_chars THEN 0.5 ELSE 0.0 END), 9) AS auc
    FROM (SELECT n_chars FROM {SCORED_SQL} WHERE quality = 1) p, (SELECT n_chars FROM {SCORED_SQL} WHERE quality = 0) n""")
def area_under_roc(spark, sf_dir):
    return evaluate.area_under_roc(scored_documents(spark, sf_dir), "quality", "n_chars").select(F.round("auc", 9).alias("auc"))


def guessed_prices(spark, sf_dir):
    """Prices of lines with a plain guess of 1,900 per piece."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_extendedprice").alias("y"), (F.col("l_quantity") * 1900).alias("guess"))


@query("e08_mean_squared_error", sql="SELECT round(avg(pow(l_extendedprice - l_quantity * 1900, 2)), 0) AS mse FROM lineitem")
def mean_squared_error(spark, sf_dir):
    return evaluate.mean_squared_error(guessed_prices(spark, sf_dir), "y", "guess").select(F.round("mse", 0).alias("mse"))


@query("e09_r_squared", sql="""
    SELECT round(1 - sum(pow(l_extendedprice - l_quantity * 1900, 2)) / sum(pow(l_extendedprice - m, 2)), 9) AS r2
    FROM lineitem, (SELECT avg(l_extendedprice) AS m FROM lineitem)""")
def r_squared(spark, sf_dir):
    return evaluate.r_squared(guessed_prices(spark, sf_dir), "y", "guess").select(F.round("r2", 9).alias("r2"))


@query("e10_rule_quality", sql=f"""
    SELECT round(count(*) FILTER (refund = 'no' AND marital_status <> 'married') / count(*), 9) AS coverage,
           round(count(*) FILTER (refund = 'no' AND marital_status <> 'married' AND cheat = 'yes')
                 / count(*) FILTER (refund = 'no' AND marital_status <> 'married'), 9) AS accuracy FROM {RETURNS_SQL}""")
def rule_quality(spark, sf_dir):
    met = (F.col("refund") == "no") & (F.col("marital_status") != "married")
    out = evaluate.rule_quality(returns(spark, sf_dir), met, "cheat", "yes")
    return out.select(*[F.round(c, 9).alias(c) for c in out.columns])


@query("e11_cluster_agreement", sql="""
    SELECT cluster, arg_min(o_orderstatus, (-n, o_orderstatus)) AS best_label, max(n) AS n_best, CAST(sum(n) AS BIGINT) AS n_rows FROM (
        SELECT CAST(floor(o_totalprice / 50000) AS BIGINT) AS cluster, o_orderstatus, count(*) AS n FROM orders GROUP BY cluster, o_orderstatus)
    GROUP BY cluster""")
def cluster_agreement(spark, sf_dir):
    """Price levels as given clusters against the order status."""
    df = table(spark, sf_dir, "orders").select(F.floor(F.col("o_totalprice") / 50000).alias("cluster"), "o_orderstatus")
    return evaluate.cluster_agreement(df, "cluster", "o_orderstatus")


@query("e12_train_test_comparison", sql=f"""
    WITH r AS (SELECT CASE WHEN floor(((l_orderkey % 2147483647) * 2654435761) % 4294967296 / 65536) % 100 < 70 THEN 'train' ELSE 'test' END AS split,
                      CAST(refund = 'no' AND income_above_80k = 'yes' AND marital_status <> 'married' AS INTEGER) = CAST(cheat = 'yes' AS INTEGER) AS ok
               FROM {RETURNS_SQL}),
    a AS (SELECT avg(CAST(ok AS INTEGER)) FILTER (split = 'train') AS tr, avg(CAST(ok AS INTEGER)) FILTER (split = 'test') AS te FROM r)
    SELECT 'full rule' AS model, 'accuracy' AS metric, round(tr, 9) AS train, round(te, 9) AS test, round(tr - te, 9) AS gap FROM a
    UNION ALL SELECT 'full rule', 'zero_one_loss', round(1 - tr, 9), round(1 - te, 9), round(te - tr, 9) FROM a""")
def train_test_comparison(spark, sf_dir):
    rows = ranking.hash_split(returns(spark, sf_dir), "l_orderkey", 70).select(
        "split",
        cols.rule_nested(rule_conditions()).alias("predicted"),
        (F.col("cheat") == "yes").cast("int").alias("y"))
    out = evaluate.compare_datasets({
        ("full rule", part): evaluate.accuracy(rows.filter(F.col("split") == part), "y", "predicted")
        for part in ("train", "test")})
    return out.withColumns({c: F.round(c, 9) for c in ("train", "test", "gap")})


MODELS_SQL = f"""
    r AS (SELECT l_linenumber = 1 AS first_line, l_quantity > 25 AS large, CAST(l_returnflag <> 'N' AS INTEGER) AS y, {LINE_SPLIT_SQL} AS train FROM lineitem),
    m AS (SELECT 'first line' AS model, first_line AS x, y, train FROM r UNION ALL SELECT 'large', large, y, train FROM r),
    p AS (SELECT model, x, avg(y) FILTER (train) AS p FROM m GROUP BY model, x),
    s AS (SELECT model, x, y, CASE WHEN train THEN 'train' ELSE 'test' END AS dataset, p, CAST(p > 0.5 AS INTEGER) AS guess FROM m JOIN p USING (model, x)),
    c AS (SELECT model, dataset, count(*) AS n, count(*) FILTER (y = 1 AND guess = 1) AS tp, count(*) FILTER (y = 0 AND guess = 1) AS fp,
        count(*) FILTER (y = 1 AND guess = 0) AS fn, count(*) FILTER (y = 1) AS pos, count(*) FILTER (y = 0) AS neg,
        count(*) FILTER (guess = y) AS hit FROM s GROUP BY model, dataset),
    v AS (SELECT model, dataset, x, any_value(p) AS p, sum(y) AS pos, sum(1 - y) AS neg FROM s GROUP BY model, dataset, x),
    a AS (SELECT a.model, a.dataset, sum(a.pos * b.neg * CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END)::DOUBLE AS wins
        FROM v a JOIN v b USING (model, dataset) GROUP BY a.model, a.dataset)"""


@query("e12_model_comparison", sql=f"""
    WITH {MODELS_SQL}, k AS (SELECT c.*, wins / pos / neg AS auc FROM c JOIN a USING (model, dataset)),
    t AS (SELECT model, dataset, 'accuracy' AS metric, hit / n AS value FROM k UNION ALL SELECT model, dataset, 'zero_one_loss', 1 - hit / n FROM k
        UNION ALL SELECT model, dataset, 'precision', CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END FROM k UNION ALL SELECT model, dataset, 'recall', tp / (tp + fn) FROM k
        UNION ALL SELECT model, dataset, 'f1', 2 * tp / (2 * tp + fp + fn) FROM k UNION ALL SELECT model, dataset, 'auc', auc FROM k)
    SELECT model, dataset, metric, round(value, 4) AS value FROM t""")
def model_comparison(spark, sf_dir):
    """Two fitted models by train and test part: accuracy, precision, recall, F1 and the area under the curve of their scores."""
    lines = ranking.hash_split(table(spark, sf_dir, "lineitem"), "l_orderkey", 70).select(
        "split", (F.col("l_linenumber") == 1).cast("double").alias("first line"), (F.col("l_quantity") > 25).cast("double").alias("large"),
        (F.col("l_returnflag") != "N").cast("int").alias("y"))
    results = {}
    for name in ("first line", "large"):
        rows = VectorAssembler(inputCols=[name], outputCol="features").transform(lines)
        model = LogisticRegression(labelCol="y", tol=1e-12, maxIter=200).fit(rows.filter("split = 'train'"))
        scored = model.transform(rows).select("split", "y", F.round(vector_to_array("probability")[1], 9).alias("score"), F.col("prediction").cast("int").alias("guess"))
        for part in ("train", "test"):
            own = scored.filter(F.col("split") == part)
            results[name, part] = evaluate.accuracy(own, "y", "guess").join(
                evaluate.precision_recall(own, "y", "guess")).join(evaluate.area_under_roc(own, "y", "score"))  # one row each
    return metric_rows(results).withColumn("value", F.round("value", 4))


def accuracy_score():
    return MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy")


def folded_vectors(spark, sf_dir, folds: int = 3):
    """Labelled vectors dealt to folds, checkpointed because every model reads them."""
    df = ranking.stratified_folds(vectors(spark, sf_dir), "label", "vec_id", folds)
    return checkpointed(ranking.plain_folds(df, "vec_id", folds, "inner_fold").select("vec_id", "features", "label", "fold", "inner_fold"))


def tree(**settings):
    return DecisionTreeClassifier(seed=7, **settings)


@query("h01_error_by_depth")
def error_by_depth(spark, sf_dir):
    """Error of a fully grown tree cut off at every depth, on train and test."""
    df = ranking.hash_split(vectors(spark, sf_dir), "vec_id", 70)
    train, test = df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")
    model = tree(maxDepth=20).fit(train)
    return tune.error_by_depth(model, train, test, "label")


SMOOTHINGS = [0.1, 1.0, 10.0, 100.0]
#: Two folds from one hash of the number; the second is fixed inside the first.
FOLD_SQL = f"floor({HASH_SQL.format(key='doc_id')} / 65536)"


def text_folds(spark, sf_dir, outer: int, inner: int = 10):
    rows, terms = labelled_texts(spark, sf_dir)
    bucket = F.floor(ranking.integer_hash(F.col("doc_id")) / 65536).cast("long")
    return rows.withColumns({"fold": bucket % outer, "inner_fold": F.floor(bucket / outer).cast("long") % inner}), terms


def folds_sql(outer: int, inner: int = 10) -> str:
    return f"""{TEXTS_SQL},
    folded AS MATERIALIZED (SELECT doc_id, quality, train, CAST({FOLD_SQL} AS BIGINT) % {outer} AS fold,
        CAST(floor({FOLD_SQL} / {outer}) AS BIGINT) % {inner} AS inner_fold FROM rows_)"""


def fold_scores_sql(outer: int, smoothings, inner: int = 10) -> str:
    """Tables up to ``fold_scores``: accuracy by fold and smoothing."""
    return f"""{folds_sql(outer, inner)},
    alphas AS (SELECT unnest([{', '.join(map(str, smoothings))}]::DOUBLE[]) AS alpha),
    fit AS (SELECT alpha, held, f.* FROM folded f, (SELECT DISTINCT fold AS held FROM folded), alphas WHERE fold <> held),
    {multinomial_sql('fit', 'alpha', 'alpha, held')},
    scored AS (SELECT doc_id, quality, fold, p.alpha, p.class, p.prior + coalesce(sum(weight * log), 0) AS score
        FROM folded JOIN priors p ON p.held = fold LEFT JOIN weights USING (doc_id)
        LEFT JOIN logs l ON l.alpha = p.alpha AND l.held = p.held AND l.class = p.class AND l.term = weights.term
        GROUP BY doc_id, quality, fold, p.alpha, p.class, p.prior),
    guessed AS (SELECT doc_id, quality, fold, alpha, arg_min(class, (-score, class)) AS guess FROM scored GROUP BY ALL),
    fold_scores AS MATERIALIZED (SELECT fold, alpha AS smoothing, avg(CAST(guess = quality AS INTEGER)) AS score FROM guessed GROUP BY fold, alpha)"""


@query("h01_error_by_smoothing", sql=f"""
    WITH {TEXTS_SQL}, alphas AS (SELECT unnest([{', '.join(map(str, SMOOTHINGS))}]::DOUBLE[]) AS alpha),
    fit AS (SELECT alpha, r.* FROM rows_ r, alphas WHERE train), {multinomial_sql('fit', 'alpha', 'alpha')},
    scored AS (SELECT doc_id, quality, train, p.alpha, p.class, p.prior + coalesce(sum(weight * log), 0) AS score
        FROM rows_ CROSS JOIN priors p LEFT JOIN weights USING (doc_id)
        LEFT JOIN logs l ON l.alpha = p.alpha AND l.class = p.class AND l.term = weights.term
        GROUP BY doc_id, quality, train, p.alpha, p.class, p.prior),
    guessed AS (SELECT doc_id, quality, train, alpha, arg_min(class, (-score, class)) AS guess FROM scored GROUP BY ALL)
    SELECT alpha AS smoothing, round(avg(CAST(guess <> quality AS INTEGER)) FILTER (train), 9) AS train,
        round(avg(CAST(guess <> quality AS INTEGER)) FILTER (NOT train), 9) AS test FROM guessed GROUP BY alpha""")
def error_by_smoothing(spark, sf_dir):
    """Error of text classification on train and test by smoothing; the texts are weighed once, summed once and scored once."""
    rows, terms = labelled_texts(spark, sf_dir)
    rows = checkpointed(rows.select("terms", "quality", "split"))
    model = bayes.MultinomialBayes(rows.filter("split = 'train'"), "quality", terms)
    guessed = model.predict_smoothed(rows, SMOOTHINGS, ["quality", "split"])
    wrong = (F.col("predicted") != F.col("quality")).cast("double")
    return guessed.groupBy("smoothing").agg(*[
        F.round(F.avg(F.when(F.col("split") == part, wrong)), 9).alias(part) for part in ("train", "test")])


@query("h03_smoothing_search", sql=f"""
    WITH {fold_scores_sql(10, SMOOTHINGS)}
    SELECT smoothing, round(avg(score), 9) AS mean, round(stddev_pop(score), 9) AS std FROM fold_scores GROUP BY smoothing""")
def smoothing_search(spark, sf_dir):
    """Ten folds and four smoothings from one pass of sums."""
    rows, terms = text_folds(spark, sf_dir, 10)
    scores = bayes.MultinomialFolds(rows, "quality", terms, ["fold"], SMOOTHINGS).scores()
    return scores.groupBy("smoothing").agg(F.round(F.avg("score"), 9).alias("mean"), F.round(F.stddev_pop("score"), 9).alias("std"))


@query("h04_text_fold_scores", sql=f"""
    WITH {fold_scores_sql(31, [1.0])}, shown AS (SELECT CAST(fold AS VARCHAR) AS fold, score FROM fold_scores
        UNION ALL SELECT 'mean', avg(score) FROM fold_scores UNION ALL SELECT 'std', stddev_pop(score) FROM fold_scores)
    SELECT fold, round(score, 9) AS score FROM shown""")
def text_fold_scores(spark, sf_dir):
    """Accuracy on each of 31 folds, their mean and deviation."""
    rows, terms = text_folds(spark, sf_dir, 31)
    scores = bayes.MultinomialFolds(rows, "quality", terms, ["fold"], [1.0]).scores()
    shown = scores.select(F.col("fold").cast("string").alias("fold"), "score").union(
        scores.agg(F.lit("mean"), F.avg("score"))).union(scores.agg(F.lit("std"), F.stddev_pop("score")))
    return shown.withColumn("score", F.round("score", 9))


@query("h05_nested_smoothing_search", sql=f"""
    WITH {fold_scores_sql(10, SMOOTHINGS)},
    nfit AS (SELECT alpha, o AS out_, i AS in_, f.* FROM folded f, (SELECT DISTINCT fold AS o FROM folded),
        (SELECT DISTINCT inner_fold AS i FROM folded), alphas WHERE fold <> o AND inner_fold <> i),
    npriors AS (SELECT alpha, out_, in_, quality AS class, ln(count(*) / sum(count(*)) OVER (PARTITION BY alpha, out_, in_)) AS prior
        FROM nfit GROUP BY alpha, out_, in_, quality),
    nsums AS (SELECT alpha, out_, in_, quality AS class, term, sum(weight) AS s FROM nfit JOIN weights USING (doc_id) GROUP BY ALL),
    ngrid AS (SELECT alpha, out_, in_, class, prior, term, coalesce(s, 0) + alpha AS s FROM npriors CROSS JOIN (SELECT term FROM vocabulary)
        LEFT JOIN nsums USING (alpha, out_, in_, class, term)),
    nlogs AS MATERIALIZED (SELECT alpha, out_, in_, class, prior, term, ln(s / sum(s) OVER (PARTITION BY alpha, out_, in_, class)) AS log FROM ngrid),
    nscored AS (SELECT doc_id, quality, p.alpha, p.out_, p.in_, p.class, p.prior + coalesce(sum(weight * log), 0) AS score
        FROM folded JOIN npriors p ON p.in_ = inner_fold AND p.out_ <> fold LEFT JOIN weights USING (doc_id)
        LEFT JOIN nlogs l ON l.alpha = p.alpha AND l.out_ = p.out_ AND l.in_ = p.in_ AND l.class = p.class AND l.term = weights.term
        GROUP BY doc_id, quality, p.alpha, p.out_, p.in_, p.class, p.prior),
    nguessed AS (SELECT doc_id, quality, alpha, out_, in_, arg_min(class, (-score, class)) AS guess FROM nscored GROUP BY ALL),
    neach AS (SELECT alpha, out_, in_, avg(CAST(guess = quality AS INTEGER)) AS score FROM nguessed GROUP BY ALL),
    nmeans AS (SELECT alpha, out_, round(avg(score), 9) AS inner_score FROM neach GROUP BY alpha, out_),
    nbest AS (SELECT out_ AS fold, arg_min(alpha, (-inner_score, alpha)) AS smoothing, max(inner_score) AS inner_score FROM nmeans GROUP BY out_)
    SELECT fold, smoothing, inner_score, round(score, 9) AS score FROM nbest JOIN fold_scores USING (fold, smoothing)""")
def nested_smoothing_search(spark, sf_dir):
    """A search over smoothings on ten inner folds inside each of ten outer ones."""
    rows, terms = text_folds(spark, sf_dir, 10, 10)
    found = bayes.MultinomialFolds(rows, "quality", terms, ["fold", "inner_fold"], SMOOTHINGS).nested_scores()
    return found.withColumn("score", F.round("score", 9))


LINE_FOLDS = 15
LINE_FOLD_SQL = f"CAST(floor({HASH_SQL.format(key='(l_orderkey * 10 + l_linenumber)')} / 65536) AS BIGINT) % {LINE_FOLDS}"


def line_fold_moments(spark, sf_dir):
    key = F.col("l_orderkey").cast("bigint") * 10 + F.col("l_linenumber")
    fold = F.floor(ranking.integer_hash(key) / 65536).cast("long") % LINE_FOLDS
    return linear.moments_by_fold(priced_lines(spark, sf_dir).withColumn("fold", fold), ["l_quantity"], "l_extendedprice", "fold")


PENALTY_FOLDS_SQL = f"""
    lines AS (SELECT l_quantity AS x, l_extendedprice AS y, {LINE_FOLD_SQL} AS fold FROM lineitem),
    train AS (SELECT held, count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS v, covar_pop(y, x) AS c
        FROM lines, (SELECT DISTINCT fold AS held FROM lines) WHERE fold <> held GROUP BY held),
    fits AS (SELECT 'lasso' AS kind, held, penalty, {shrunk('lasso')} AS b, mx, my FROM train, {PENALTY_SQL}
        UNION ALL SELECT 'ridge', held, penalty, {shrunk('ridge')}, mx, my FROM train, {PENALTY_SQL}),
    each AS (SELECT kind, penalty, held, avg(pow(y - my - b * (x - mx), 2)) FILTER (fold <> held) AS train_mse,
        avg(pow(y - my - b * (x - mx), 2)) FILTER (fold = held) AS mse FROM lines, fits GROUP BY kind, penalty, held)"""


def penalty_scores(spark, sf_dir):
    moments = line_fold_moments(spark, sf_dir)
    rows = [(kind, float(p), int(fold), train, held) for kind in ("lasso", "ridge") for p, fold, train, held in linear.penalty_search(moments, PENALTIES, kind)]
    return spark.createDataFrame(rows, "kind string, penalty double, fold bigint, train_mse double, mse double")


@query("h06_penalty_curve", sql=f"""
    WITH {PENALTY_FOLDS_SQL}
    SELECT kind, penalty, round(avg(train_mse) / 1e6, 6) AS train, round(avg(mse) / 1e6, 6) AS validation, round(stddev_pop(mse) / 1e6, 6) AS std
    FROM each GROUP BY kind, penalty""")
def penalty_curve(spark, sf_dir):
    """Train and validation error of lasso and ridge over penalties on fifteen folds, from one pass over the lines."""
    return penalty_scores(spark, sf_dir).groupBy("kind", "penalty").agg(
        F.round(F.avg("train_mse") / 1e6, 6).alias("train"), F.round(F.avg("mse") / 1e6, 6).alias("validation"),
        F.round(F.stddev_pop("mse") / 1e6, 6).alias("std"))


@query("h08_best_penalty", sql=f"""
    WITH {PENALTY_FOLDS_SQL}, means AS (SELECT kind, penalty, round(avg(mse) / 1e6, 9) AS error FROM each GROUP BY kind, penalty),
    best AS (SELECT kind, arg_min(penalty, (error, penalty)) AS penalty FROM means GROUP BY kind),
    m AS (SELECT count(*) AS n, avg(x) AS mx, avg(y) AS my, var_pop(x) AS v, covar_pop(y, x) AS c FROM lines),
    fit AS (SELECT kind, penalty, CASE kind WHEN 'lasso' THEN {shrunk('lasso')} ELSE {shrunk('ridge')} END AS b, mx, my FROM best, m)
    SELECT kind, penalty, round(my - b * mx, 3) AS intercept, round(b, 3) AS slope FROM fit""")
def best_penalty(spark, sf_dir):
    """The penalty with the least error over the folds, refitted on all lines."""
    moments = line_fold_moments(spark, sf_dir)
    whole, rows = reduce(linear.Moments.__add__, moments.values()), []
    for kind in ("lasso", "ridge"):
        errors: dict[float, list[float]] = {}
        for p, _, _, held in linear.penalty_search(moments, PENALTIES, kind):
            errors.setdefault(p, []).append(held)
        best = min(errors, key=lambda p: (round(sum(errors[p]) / len(errors[p]) / 1e6, 9), p))
        fit = linear.penalty_path(whole, [best], kind)[best]
        rows.append((kind, float(best), round(fit.intercept, 3), round(float(fit.coefficients[0]), 3)))
    return spark.createDataFrame(rows, "kind string, penalty double, intercept double, slope double")


TREE_DEPTHS, TREE_FEATURES, TREE_FOLDS = range(1, 20), [0.2, 0.4, 0.6, 0.8], 8


def tree_search(spark, sf_dir):
    """Nineteen depths and four shares of features on eight folds: mean and deviation of the fold scores."""
    scores = tune.depth_search(folded_vectors(spark, sf_dir, TREE_FOLDS), "label", "fold", TREE_FOLDS, TREE_DEPTHS, TREE_FEATURES)
    return scores.groupBy("depth", "features").agg(F.avg("validation").alias("mean"), F.stddev_pop("validation").alias("std"))


@query("h03_grid_search")
def grid_search(spark, sf_dir):
    return tree_search(spark, sf_dir)


@query("h04_fold_scores")
def fold_scores(spark, sf_dir):
    """Score of each fold with their mean and deviation."""
    scores = tune.fold_scores(tree(maxDepth=5), accuracy_score(), folded_vectors(spark, sf_dir), "fold", 3)
    return scores.select(
        F.col("fold").cast("string").alias("fold"), "score"
    ).union(scores.agg(F.lit("mean"), F.avg("score"))).union(scores.agg(F.lit("std"), F.stddev_pop("score")))


@query("h05_nested_search")
def nested_search(spark, sf_dir):
    estimator = tree()
    grid = [{estimator.maxDepth: d} for d in (3, 6)]
    return tune.nested_search(estimator, grid, accuracy_score(), folded_vectors(spark, sf_dir), "fold", 3, "inner_fold", 3)


@query("h06_validation_curve")
def validation_curve(spark, sf_dir):
    """Accuracy of trees by depth on eight folds."""
    scores = tune.depth_search(folded_vectors(spark, sf_dir, TREE_FOLDS), "label", "fold", TREE_FOLDS, TREE_DEPTHS)
    return scores.groupBy(F.col("depth").cast("double").alias("value")).agg(F.avg("train").alias("train"), F.avg("validation").alias("validation"))


@query("h07_elbow")
def elbow(spark, sf_dir):
    return tune.elbow(vectors(spark, sf_dir).select("features"), range(4, 20))


@query("h08_best_parameters")
def best_parameters(spark, sf_dir):
    """Predictions of the best tree of the grid search, refitted on all rows, with its parameters."""
    df = vectors(spark, sf_dir)
    order = F.struct(-F.col("mean"), F.col("depth"), F.col("features"))
    best = tree_search(spark, sf_dir).agg(F.min_by(F.struct("depth", "features"), order).alias("b")).first()["b"]  # one row
    model = RandomForestClassifier(
        numTrees=1, bootstrap=False, featureSubsetStrategy=str(best["features"]), maxDepth=best["depth"], seed=7).fit(df)
    return model.transform(df).select(
        "vec_id", "label", "prediction", F.lit(best["depth"]).alias("depth"), F.lit(best["features"]).alias("features"))
