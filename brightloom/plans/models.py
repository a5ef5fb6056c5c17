"""Models: neighbours, Bayes and regressions with SQL beside them, and library models."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, NaiveBayes, RandomForestClassifier,
)
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from brightloom.operators import bayes, evaluate, features as feat, knn, linear, ranking
from brightloom.plans.aggregation import HASH_SQL
from brightloom.plans.column_operations import K_SQL, RETURNS_SQL, events_k, returns
from brightloom.plans.joins_sets import embedded, embedding_neighbours, pairs_sql
from brightloom.plans.preparation import COUNTS_SQL
from brightloom.plans.registry import dealt, query, table
from brightloom.plans.streams import SENSOR, sensor_rows
from brightloom.session import checkpointed


def buyers(spark, sf_dir):
    """Customers with their balance and largest order as features and their number of orders as target."""
    totals = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.count("*").alias("y"), F.max("o_totalprice").alias("largest"))
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_acctbal").join(totals, "id").select(
        "id", F.array(F.col("c_acctbal"), F.col("largest") / 10).alias("features"), "y")


def buyer_pairs_sql(distance: str) -> str:
    return f"""
    buyers AS MATERIALIZED (SELECT c_custkey AS id, any_value(c_acctbal) AS a, max(o_totalprice) / 10 AS b, count(*) AS y
        FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey),
    pairs AS (SELECT q.id, q.y AS actual, t.y, d, row_number() OVER (PARTITION BY q.id ORDER BY d, t.id) AS r FROM
        (SELECT q.id AS qid, t.id AS tid, {distance} AS d FROM buyers q JOIN buyers t ON q.id <> t.id)
        JOIN buyers q ON q.id = qid JOIN buyers t ON t.id = tid)"""


STRAIGHT = "sqrt(pow(q.a - t.a, 2) + pow(q.b - t.b, 2))"
BLOCKS = "abs(q.a - t.a) + abs(q.b - t.b)"


def buyer_neighbours(spark, sf_dir, k: int, p: int = 2):
    rows = buyers(spark, sf_dir)
    return rows, knn.nearest_neighbours(rows.withColumnRenamed("id", "query"), rows, k, "query", "id", p=p, exclude_self=True)


@query("l06_neighbour_regression", sql=f"""
    WITH {buyer_pairs_sql(STRAIGHT)} SELECT id, round(avg(y), 6) AS predicted FROM pairs WHERE r <= 5 GROUP BY id""")
def neighbour_regression(spark, sf_dir):
    """Orders of a customer as the mean of the five customers nearest in balance and largest order."""
    rows, near = buyer_neighbours(spark, sf_dir, 5)
    return knn.knn_regress(near, rows, "query", "id", "y").select(
        F.col("query").alias("id"), F.round("predicted", 6).alias("predicted"))


@query("l07_neighbour_classification", sql=f"""
    SELECT query AS id, arg_min(label, (-votes, label)) AS predicted FROM (
        SELECT query, label, count(*) AS votes FROM {pairs_sql()} WHERE rank <= 41 GROUP BY query, label) GROUP BY query""")
def neighbour_classification(spark, sf_dir):
    """Label of every vector by majority of its 41 nearest others."""
    near = embedding_neighbours(spark, sf_dir, 41)
    return knn.knn_classify(near, embedded(spark, sf_dir, "label"), "query", "id", "label").select(
        F.col("query").alias("id"), "predicted")


@query("l08_weighted_neighbours", sql=f"""
    WITH {buyer_pairs_sql(BLOCKS)} SELECT id, round(sum(y / d) / sum(1 / d), 6) AS predicted FROM pairs WHERE r <= 7 GROUP BY id""")
def weighted_neighbours(spark, sf_dir):
    """Seven nearest by Manhattan distance, weighted by one over distance."""
    rows, near = buyer_neighbours(spark, sf_dir, 7, p=1)
    return knn.knn_regress(near, rows, "query", "id", "y", weights="distance").select(
        F.col("query").alias("id"), F.round("predicted", 6).alias("predicted"))


def split_pairs_sql(distance: str, depth: int) -> str:
    """Every buyer as a query ``q`` against the buyers of the train part ``t``, ranked by distance."""
    return f"""
    buyers AS MATERIALIZED (SELECT c_custkey AS id, any_value(c_acctbal) AS a, max(o_totalprice) / 10 AS b, count(*) AS y,
            floor({HASH_SQL.format(key='c_custkey')} / 65536) % 100 < 70 AS train
        FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey),
    scale AS (SELECT avg(a) AS ma, stddev_pop(a) AS sa, avg(b) AS mb, stddev_pop(b) AS sb FROM buyers WHERE train),
    scaled AS MATERIALIZED (SELECT id, y, train, (a - ma) / sa AS sa, (b - mb) / sb AS sb, a, b FROM buyers, scale),
    pairs AS MATERIALIZED (SELECT * FROM (SELECT q.id, q.y AS actual, q.train, t.y, {distance} AS d,
        row_number() OVER (PARTITION BY q.id ORDER BY {distance}, t.id) AS r FROM scaled q CROSS JOIN scaled t WHERE t.train) WHERE r <= {depth})"""


def split_buyers(spark, sf_dir):
    return ranking.hash_split(buyers(spark, sf_dir), "id", 70)


@query("h02_error_by_k", sql=f"""
    WITH {split_pairs_sql(STRAIGHT, 49)},
    guesses AS (SELECT train, r, actual, avg(y) OVER (PARTITION BY id ORDER BY r ROWS UNBOUNDED PRECEDING) AS guess FROM pairs)
    SELECT CASE WHEN train THEN 'train' ELSE 'test' END AS split, r AS k, round(avg(pow(actual - guess, 2)), 10) AS mse FROM guesses GROUP BY train, r""")
def error_by_k(spark, sf_dir):
    """One ranking gives the error of every k up to 49, on train and test."""
    rows = split_buyers(spark, sf_dir)
    queries, train = rows.withColumnRenamed("id", "query"), rows.filter("split = 'train'")
    near = knn.nearest_neighbours(queries, train, 49, "query", "id")
    return knn.knn_error_by_k(near, queries, train, "query", "id", "y", by=["split"]).withColumn("mse", F.round("mse", 10))


SCALED = {2: "sqrt(pow(q.sa - t.sa, 2) + pow(q.sb - t.sb, 2))", 1: "abs(q.sa - t.sa) + abs(q.sb - t.sb)"}


def _search_sql(p: int) -> str:
    return f"""
    (WITH {split_pairs_sql(SCALED[p], 49)},
    weighed AS (SELECT *, min(d) OVER (PARTITION BY id) AS least FROM pairs WHERE NOT train),
    kinds AS (SELECT *, 'uniform' AS weights, 1.0::DOUBLE AS w FROM weighed
        UNION ALL SELECT *, 'distance', CASE WHEN least = 0 THEN CAST(d = 0 AS DOUBLE) ELSE 1 / d END FROM weighed),
    guesses AS (SELECT weights, r, actual, sum(w * y) OVER (PARTITION BY weights, id ORDER BY r ROWS UNBOUNDED PRECEDING)
        / sum(w) OVER (PARTITION BY weights, id ORDER BY r ROWS UNBOUNDED PRECEDING) AS guess FROM kinds)
    SELECT {p} AS p, weights, r AS k, round(avg(pow(actual - guess, 2)), 10) AS mse FROM guesses GROUP BY weights, r)"""


@query("h03_neighbour_search", sql=f"""
    WITH found AS ({_search_sql(1)} UNION ALL {_search_sql(2)})
    SELECT *, row_number() OVER (ORDER BY mse, p, weights, k) = 1 AS best FROM found""")
def neighbour_search(spark, sf_dir):
    """Error on the test part by metric, weights and k up to 49, on inputs scaled by the train part."""
    rows = split_buyers(spark, sf_dir).select("id", "y", "split", F.col("features")[0].alias("a"), F.col("features")[1].alias("b"))
    scaling = feat.learn_standard(rows.filter("split = 'train'"), ["a", "b"])
    rows = scaling.apply(rows).select("id", "y", "split", F.array("a", "b").alias("features"))
    queries, train = rows.filter("split = 'test'").withColumnRenamed("id", "query"), rows.filter("split = 'train'")
    parts = []
    for p in (1, 2):
        near = checkpointed(knn.nearest_neighbours(queries, train, 49, "query", "id", p=p))
        parts += [
            knn.knn_error_by_k(near, queries, train, "query", "id", "y", weights=w).select(F.lit(p).alias("p"), F.lit(w).alias("weights"), "k", F.round("mse", 10).alias("mse"))
            for w in ("uniform", "distance")]
    found = checkpointed(reduce(DataFrame.union, parts))
    best = found.agg(F.min(F.struct("mse", "p", "weights", "k")).alias("b")).first()["b"]  # one row
    return found.withColumn("best", (F.col("p") == best["p"]) & (F.col("weights") == best["weights"]) & (F.col("k") == best["k"]))


RULE_ATTRIBUTES = ["refund", "marital_status", "income_above_80k"]


def bayes_sql(smoothing: int) -> str:
    shares = " * ".join(
        f"(SELECT (count(*) FILTER (t.{a} = r.{a}) + {smoothing}.0::DOUBLE) / (count(*) + {smoothing} * (SELECT count(DISTINCT {a}) FROM rows_))"
        f" FROM rows_ t WHERE t.cheat = c.cheat)" for a in RULE_ATTRIBUTES)
    return f"""
    WITH rows_ AS MATERIALIZED (SELECT * FROM {RETURNS_SQL}),
    classes AS (SELECT cheat, count(*) / (SELECT count(*) FROM rows_) AS prior FROM rows_ GROUP BY cheat),
    kinds AS (SELECT DISTINCT refund, marital_status, income_above_80k FROM rows_),
    scores AS (SELECT r.*, c.cheat AS class, c.prior * {shares} AS score FROM kinds r CROSS JOIN classes c),
    best AS (SELECT refund, marital_status, income_above_80k, arg_min(class, (-score, class)) AS predicted,
                    round(max(score) / sum(score), 9) AS probability FROM scores GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, predicted, probability FROM rows_ JOIN best USING (refund, marital_status, income_above_80k)"""


def categorical_bayes(spark, sf_dir, smoothing: float):
    rows = returns(spark, sf_dir)
    model = bayes.CategoricalBayes(rows, RULE_ATTRIBUTES, "cheat", smoothing)
    return model.predict(rows, ["l_orderkey", "l_linenumber"]).withColumn("probability", F.round("probability", 9))


@query("l08_hashed_neighbours")
def hashed_neighbours(spark, sf_dir):
    """Ten nearest others of every vector by hash tables of random projections, the form for large tables."""
    rows = embedded(spark, sf_dir, "label")
    near = knn.hashed_neighbours(rows.withColumnRenamed("id", "query"), rows, 10, "query", "id", exclude_self=True)
    return near.select("query", F.col("train_id").alias("train"), "distance", "rank")


@query("l09_categorical_bayes", sql=bayes_sql(0))
def categorical_bayes_plain(spark, sf_dir):
    return categorical_bayes(spark, sf_dir, 0.0)


@query("l10_gaussian_bayes", sql=f"""
    WITH r AS MATERIALIZED (SELECT event_id, event_type, value, CAST({K_SQL} AS DOUBLE) AS k FROM events),
    m AS (SELECT event_type AS class, count(*) / (SELECT count(*) FROM r) AS prior, avg(value) AS mv, stddev_samp(value) AS sv,
                 avg(k) AS mk, stddev_samp(k) AS sk FROM r GROUP BY event_type),
    scores AS (SELECT event_id, class, prior * exp(-pow((value - mv) / sv, 2) / 2) / (sv * sqrt(2 * pi()))
                      * exp(-pow((k - mk) / sk, 2) / 2) / (sk * sqrt(2 * pi())) AS score FROM r CROSS JOIN m)
    SELECT event_id, arg_min(class, (-score, class)) AS predicted, round(max(score) / sum(score), 6) AS probability
    FROM scores GROUP BY event_id""")
def gaussian_bayes(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value", events_k().cast("double").alias("k"))
    model = bayes.GaussianBayes(rows, ["value", "k"], "event_type")
    return model.predict(rows, ["event_id"]).withColumn("probability", F.round("probability", 6))


@query("l11_smoothed_bayes", sql=bayes_sql(1))
def smoothed_bayes(spark, sf_dir):
    """The library's categorical variant: one is added to every count."""
    return categorical_bayes(spark, sf_dir, 1.0)


def vectors(spark, sf_dir):
    """Embeddings as vectors with the label, and with a two-class label."""
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
        F.col("label").cast("double").alias("label"), (F.col("label") < 5).cast("double").alias("low_label"))


def weighed_texts(spark, sf_dir, size: int = 100):
    """Documents with TF-IDF weights over the ``size`` most frequent terms, and the terms in order; every document has a row."""
    counts = feat.term_counts(dealt(spark, sf_dir, "documents"), "doc_id", "text")
    top = checkpointed(feat.top_terms(counts, size))  # read twice
    return feat.tfidf(counts, top, counts.count()), sorted(r["term"] for r in top.collect())


def labelled_texts(spark, sf_dir):
    """Weighed texts with their quality label, dealt to train and test by number, and the terms."""
    weighed, terms = weighed_texts(spark, sf_dir)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return ranking.hash_split(weighed.join(labels, "doc_id"), "doc_id", 70), terms


@query("l11_library_bayes")
def library_bayes(spark, sf_dir):
    """Gaussian Bayes of the library on vectors, multinomial Bayes on the weights of labelled documents: fitted on train, scored on test."""
    df = ranking.hash_split(vectors(spark, sf_dir), "vec_id", 70)
    gaussian = NaiveBayes(modelType="gaussian").fit(df.filter("split = 'train'")).transform(df).select(
        F.lit("gaussian").alias("model"), F.col("vec_id").alias("id"), "split", "label", "prediction")
    rows, terms = labelled_texts(spark, sf_dir)
    wide = feat.weight_vectors(rows, terms).withColumn("label", F.col("quality").cast("double"))
    multinomial = NaiveBayes(modelType="multinomial").fit(wide.filter("split = 'train'")).transform(wide).select(
        F.lit("multinomial").alias("model"), F.col("doc_id").alias("id"), "split", "label", "prediction")
    return gaussian.union(multinomial)


TEXTS_SQL = f"""{COUNTS_SQL},
    raw AS (SELECT doc_id, term, n * (ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1 + n_texts)) + 1) AS raw
        FROM counts JOIN vocabulary USING (term)),
    weights AS MATERIALIZED (SELECT doc_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)) AS weight FROM raw),
    rows_ AS MATERIALIZED (SELECT doc_id, quality, floor({HASH_SQL.format(key='doc_id')} / 65536) % 100 < 70 AS train FROM labels
        WHERE doc_id IN (SELECT doc_id FROM documents))"""


def multinomial_sql(train: str, smoothing: str, extra: str = "") -> str:
    """Log scores of all classes, learned on the rows that ``train`` names, per group of ``extra`` columns."""
    keys = f"{extra}, " if extra else ""
    return f"""
    priors AS (SELECT {keys}quality AS class, ln(count(*) / sum(count(*)) OVER ({f'PARTITION BY {extra}' if extra else ''})) AS prior
        FROM {train} GROUP BY {keys}quality),
    sums AS (SELECT {keys}quality AS class, term, sum(weight) AS s FROM {train} JOIN weights USING (doc_id) GROUP BY {keys}quality, term),
    grid AS (SELECT {keys}class, prior, term, coalesce(s, 0) + {smoothing} AS s FROM priors CROSS JOIN (SELECT term FROM vocabulary)
        LEFT JOIN sums USING ({keys}class, term)),
    logs AS MATERIALIZED (SELECT {keys}class, prior, term, ln(s / sum(s) OVER (PARTITION BY {keys}class)) AS log FROM grid)"""


@query("l11_multinomial_bayes", sql=f"""
    WITH {TEXTS_SQL}, fit AS (SELECT * FROM rows_ WHERE train), {multinomial_sql('fit', '1.0')},
    scores AS (SELECT doc_id, quality, train, p.class, p.prior + coalesce(sum(weight * log), 0) AS score
        FROM rows_ CROSS JOIN priors p LEFT JOIN weights USING (doc_id) LEFT JOIN logs l ON l.class = p.class AND l.term = weights.term
        GROUP BY doc_id, quality, train, p.class, p.prior),
    best AS (SELECT doc_id, quality, train, arg_min(class, (-score, class)) AS predicted, max(score) AS top FROM scores GROUP BY ALL)
    SELECT doc_id, CASE WHEN train THEN 'train' ELSE 'test' END AS split, quality, predicted, round(1 / sum(exp(score - top)), 6) AS probability
    FROM best JOIN scores USING (doc_id, quality, train) GROUP BY doc_id, train, quality, predicted""")
def multinomial_bayes(spark, sf_dir):
    """Quality of every labelled document from its TF-IDF weights, learned on the train part."""
    rows, terms = labelled_texts(spark, sf_dir)
    model = bayes.MultinomialBayes(rows.filter("split = 'train'"), "quality", terms)
    return model.predict(rows, ["doc_id", "split", "quality"]).withColumn("probability", F.round("probability", 6))


def scored(model, df, *keep):
    """Prediction and the probability of the predicted class."""
    return model.transform(df).select(
        *keep, "prediction", F.array_max(vector_to_array("probability")).alias("probability"))


def split_vectors(spark, sf_dir):
    """Vectors tagged train or test by number, and the train part."""
    df = ranking.hash_split(vectors(spark, sf_dir), "vec_id", 70)
    return df, df.filter(F.col("split") == "train")


@query("l01_logistic_regression")
def logistic_regression(spark, sf_dir):
    df, train = split_vectors(spark, sf_dir)
    return scored(LogisticRegression(labelCol="low_label").fit(train), df, "vec_id", "split", "low_label")


LINE_SPLIT_SQL = f"floor({HASH_SQL.format(key='l_orderkey')} / 65536) % 100 < 70"


@query("l01_two_group_logit", sql=f"""
    WITH r AS (SELECT l_orderkey, l_linenumber, l_linenumber = 1 AS x, CAST(l_returnflag = 'R' AS INTEGER) AS y, {LINE_SPLIT_SQL} AS train FROM lineitem),
    p AS (SELECT x, avg(y) FILTER (train) AS p FROM r GROUP BY x)
    SELECT l_orderkey, l_linenumber, CASE WHEN train THEN 'train' ELSE 'test' END AS split, y,
        CAST(p > 0.5 AS DOUBLE) AS prediction, round(p, 4) AS probability FROM r JOIN p USING (x)""")
def two_group_logit(spark, sf_dir):
    """With one 0/1 input the fitted probabilities are the shares within the two groups of the train part."""
    rows = ranking.hash_split(table(spark, sf_dir, "lineitem"), "l_orderkey", 70).select(
        "l_orderkey", "l_linenumber", "split", (F.col("l_linenumber") == 1).cast("double").alias("x"), (F.col("l_returnflag") == "R").cast("int").alias("y"))
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    model = LogisticRegression(labelCol="y", tol=1e-12, maxIter=200).fit(rows.filter("split = 'train'"))
    return model.transform(rows).select(
        "l_orderkey", "l_linenumber", "split", "y", "prediction", F.round(vector_to_array("probability")[1], 4).alias("probability"))


@query("l02_forest_regression")
def forest_regression(spark, sf_dir):
    rows = VectorAssembler(inputCols=SENSOR, outputCol="features").transform(sensor_rows(table(spark, sf_dir, "events")))
    rows = ranking.hash_split(rows, "event_id", 80)
    model = RandomForestRegressor(labelCol="occupancy", numTrees=100, maxDepth=15, seed=7).fit(rows.filter("split = 'train'"))
    return model.transform(rows).select("event_id", "split", "occupancy", "prediction")


@query("l03_forest_classification")
def forest_classification(spark, sf_dir):
    df, train = split_vectors(spark, sf_dir)
    return scored(RandomForestClassifier(numTrees=100, maxDepth=10, seed=7).fit(train), df, "vec_id", "split", "label")


@query("l04_tree_classification")
def tree_classification(spark, sf_dir):
    """Predictions of a fully grown tree with the depth it reached."""
    df, train = split_vectors(spark, sf_dir)
    model = DecisionTreeClassifier(maxDepth=20, seed=7).fit(train)
    return scored(model, df, "vec_id", "split", "label").withColumn("depth", F.lit(model.depth))


@query("l05_boosted_trees")
def boosted_trees(spark, sf_dir):
    df, train = split_vectors(spark, sf_dir)
    return scored(GBTClassifier(labelCol="low_label", maxIter=100, maxDepth=10, seed=7).fit(train), df, "vec_id", "split", "low_label")


LINE_INPUTS = ["l_quantity", "l_discount", "l_tax"]


def priced_lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice")


@query("l12_batch_gradient_descent", sql="""
    WITH s AS (SELECT (l_quantity - (SELECT avg(l_quantity) FROM lineitem)) / (SELECT stddev_pop(l_quantity) FROM lineitem) AS x,
                      l_extendedprice AS y FROM lineitem)
    SELECT 'intercept' AS term, round(regr_intercept(y, x), 3) AS coefficient FROM s
    UNION ALL SELECT 'l_quantity', round(regr_slope(y, x), 3) FROM s""")
def batch_gradient_descent(spark, sf_dir):
    lines = priced_lines(spark, sf_dir)
    scaled = feat.learn_standard(lines, ["l_quantity"]).apply(lines)
    beta = linear.batch_gradient_descent(scaled, ["l_quantity"], "l_extendedprice")
    return spark.createDataFrame(
        list(zip(["intercept", "l_quantity"], beta)), "term string, coefficient double"
    ).withColumn("coefficient", F.round("coefficient", 3))


@query("l13_stochastic_gradient_descent", sql="""
    WITH s AS (SELECT (l_quantity - avg(l_quantity) OVER ()) / stddev_pop(l_quantity) OVER () AS x, l_extendedprice AS y FROM lineitem)
    SELECT 'intercept' AS term, round(regr_intercept(y, x), 3) AS coefficient, true AS converged FROM s
    UNION ALL SELECT 'l_quantity', round(regr_slope(y, x), 3), true FROM s""")
def stochastic_gradient_descent(spark, sf_dir):
    """Mini-batch steps until they move nothing: the least squares fit."""
    lines = priced_lines(spark, sf_dir)
    scaled = feat.learn_standard(lines, ["l_quantity"]).apply(lines)
    found = linear.stochastic_gradient_descent(scaled, ["l_quantity"], "l_extendedprice")
    return spark.createDataFrame(
        [(t, b, found.converged) for t, b in zip(["intercept", "l_quantity"], found.coefficients)],
        "term string, coefficient double, converged boolean").withColumn("coefficient", F.round("coefficient", 3))


@query("l14_least_squares_table", sql="""
    WITH b AS (SELECT sum(l_quantity * l_extendedprice) / sum(l_quantity * l_quantity) AS b FROM lineitem),
    e AS (SELECT b, sum(pow(l_extendedprice - b * l_quantity, 2)) AS sse, sum(l_quantity * l_quantity) AS xx,
                 sum(l_extendedprice * l_extendedprice) AS yy, count(*) AS n FROM lineitem, b GROUP BY b)
    SELECT 'l_quantity' AS term, round(b, 4) AS coefficient, round(sqrt(sse / (n - 1) / xx), 5) AS std_error,
           round(b / sqrt(sse / (n - 1) / xx), 3) AS t, CAST(0 AS DOUBLE) AS p, round(1 - sse / yy, 6) AS r2 FROM e""")
def least_squares_table(spark, sf_dir):
    """Price on quantity without an intercept."""
    out = linear.least_squares_table(priced_lines(spark, sf_dir), ["l_quantity"], "l_extendedprice")
    digits = {"coefficient": 4, "std_error": 5, "t": 3, "p": 9, "r2": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


def regression(spark, sf_dir, names, **settings):
    """Price on scaled columns; one row per fitted coefficient."""
    chain = Pipeline(stages=[
        VectorAssembler(inputCols=names, outputCol="raw"),
        StandardScaler(withMean=True, inputCol="raw", outputCol="features"),
        LinearRegression(labelCol="l_extendedprice", **settings)])
    model = chain.fit(priced_lines(spark, sf_dir)).stages[-1]
    return spark.createDataFrame(
        [("intercept", float(model.intercept)), *[(n, float(c)) for n, c in zip(names, model.coefficients)]],
        "term string, coefficient double")


@query("l15_scaled_line", sql="""
    WITH s AS (SELECT (l_quantity - avg(l_quantity) OVER ()) / stddev_samp(l_quantity) OVER () AS x, l_extendedprice AS y FROM lineitem)
    SELECT 'intercept' AS term, round(regr_intercept(y, x), 3) AS coefficient FROM s
    UNION ALL SELECT 'l_quantity', round(regr_slope(y, x), 3) FROM s""")
def scaled_line(spark, sf_dir):
    """Price on one scaled column."""
    return regression(spark, sf_dir, ["l_quantity"]).withColumn("coefficient", F.round("coefficient", 3))


@query("l15_scaled_regression")
def scaled_regression(spark, sf_dir):
    return regression(spark, sf_dir, LINE_INPUTS)


#: Ten penalties between 0.001 and 1, evenly in logarithms, and some that shrink prices visibly.
PENALTIES = [10 ** (-3 + i / 3) for i in range(10)] + [100.0, 1000.0, 10_000.0]


@query("l16_lasso_and_ridge")
def lasso_and_ridge(spark, sf_dir):
    """Price on three inputs by lasso and ridge over a list of penalties, from one pass over the lines."""
    moments = linear.moments_by_fold(priced_lines(spark, sf_dir), LINE_INPUTS, "l_extendedprice")[None]
    rows = [
        (kind, float(penalty), term, float(b))
        for kind in ("lasso", "ridge") for penalty, fit in linear.penalty_path(moments, PENALTIES, kind).items()
        for term, b in zip(["intercept", *LINE_INPUTS], [fit.intercept, *fit.coefficients])]
    return spark.createDataFrame(rows, "kind string, penalty double, term string, coefficient double")


PENALTY_SQL = f"(SELECT unnest([{', '.join(repr(p) for p in PENALTIES)}]::DOUBLE[]) AS penalty)"


def shrunk(kind: str) -> str:
    """Slope on the raw input for a penalty on the standardised one, from covariance ``c``, variance ``v`` and number ``n``."""
    if kind == "ridge":
        return "c * n / (v * (n + penalty))"
    return "sign(c) * greatest(abs(c) / sqrt(v) - penalty, 0) / sqrt(v)"


@query("l16_penalty_path", sql=f"""
    WITH m AS (SELECT count(*) AS n, avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_pop(l_quantity) AS v,
        covar_pop(l_extendedprice, l_quantity) AS c FROM lineitem),
    fits AS (SELECT 'lasso' AS kind, penalty, {shrunk('lasso')} AS b, mx, my FROM m, {PENALTY_SQL}
        UNION ALL SELECT 'ridge', penalty, {shrunk('ridge')}, mx, my FROM m, {PENALTY_SQL})
    SELECT kind, penalty, round(my - b * mx, 3) AS intercept, round(b, 3) AS slope FROM fits""")
def penalty_path(spark, sf_dir):
    """With one input lasso is the soft threshold and ridge a shrinking of the slope."""
    moments = linear.moments_by_fold(priced_lines(spark, sf_dir), ["l_quantity"], "l_extendedprice")[None]
    rows = [(kind, float(p), fit.intercept, float(fit.coefficients[0]))
            for kind in ("lasso", "ridge") for p, fit in linear.penalty_path(moments, PENALTIES, kind).items()]
    return spark.createDataFrame(rows, "kind string, penalty double, intercept double, slope double").withColumns(
        {c: F.round(c, 3) for c in ("intercept", "slope")})


@query("l17_k_means")
def k_means(spark, sf_dir):
    df = vectors(spark, sf_dir)
    out = df.select("vec_id", "features", "label")
    for k in (8, 2):
        out = KMeans(k=k, seed=7, predictionCol=f"cluster_of_{k}").fit(df).transform(out)
    return out.drop("features")


@query("l17_components_then_clusters")
def components_then_clusters(spark, sf_dir):
    """Two components and eight clusters learned on train; test rows go through the train projection. Each cluster stands for its best class."""
    df, train = split_vectors(spark, sf_dir)
    chain = Pipeline(stages=[*feat.centred_pca("features", 2, "parts").getStages(), KMeans(k=8, seed=7, featuresCol="parts", predictionCol="cluster")])
    placed = chain.fit(train).transform(df)
    best = evaluate.cluster_agreement(placed.filter("split = 'train'"), "cluster", "label").select("cluster", F.col("best_label").alias("prediction"))
    guessed = placed.join(F.broadcast(best), "cluster")  # one row a cluster
    reports = [
        evaluate.class_report(guessed.filter(F.col("split") == part), "label", "prediction").withColumn("split", F.lit(part)) for part in ("train", "test")]
    return reports[0].unionByName(reports[1])


@query("l18_model_scoring")
def model_scoring(spark, sf_dir):
    """Predicted class with the probability of every class."""
    df, train = split_vectors(spark, sf_dir)
    probabilities = vector_to_array("probability")
    return RandomForestClassifier(labelCol="low_label", numTrees=10, seed=7).fit(train).transform(df).select(
        "vec_id", "split", "prediction", probabilities[0].alias("probability_0"), probabilities[1].alias("probability_1"))


@query("l19_residuals", sql="""
    SELECT l_orderkey, l_linenumber, l_extendedprice, round(p, 3) AS predicted, round(l_extendedprice - p, 3) AS residual FROM (
        SELECT *, (SELECT regr_intercept(l_extendedprice, l_quantity) FROM lineitem)
                + (SELECT regr_slope(l_extendedprice, l_quantity) FROM lineitem) * l_quantity AS p FROM lineitem)""")
def residuals(spark, sf_dir):
    lines = priced_lines(spark, sf_dir)
    fit = lines.agg(
        F.regr_intercept("l_extendedprice", "l_quantity").alias("a"), F.regr_slope("l_extendedprice", "l_quantity").alias("b")).first()
    predicted = lines.withColumn("predicted", linear.linear_prediction([fit["a"], fit["b"]], ["l_quantity"]))
    return evaluate.with_residual(predicted, "l_extendedprice", "predicted").select(
        "l_orderkey", "l_linenumber", "l_extendedprice", F.round("predicted", 3).alias("predicted"),
        F.round("residual", 3).alias("residual"))
