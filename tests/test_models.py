"""Neighbours against brute force, Bayes, regression, stages and model invariants."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from brightloom.operators import bayes, evaluate, features as feat, knn, linear
from brightloom.operators.stages import AgeClasses, Indicators


def brute_force(x, y, k, p, exclude_self=False):
    out = {}
    for i, q in enumerate(x):
        d = np.abs(y - q).sum(axis=1) if p == 1 else np.sqrt(((y - q) ** 2).sum(axis=1))
        ranked = sorted((d[j], j) for j in range(len(y)) if not (exclude_self and i == j))[:k]
        out[i] = [j for _, j in ranked]
    return out


def frame(spark, x, name):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{name} long, features array<double>")


def lists(found, query_id):
    out = {}
    for r in found.orderBy(query_id, "rank").collect():
        out.setdefault(r[query_id], []).append(r["train_id"])
    return out


@pytest.mark.parametrize("p", [1, 2])
def test_neighbours_equal_brute_force(spark, p):
    rng = np.random.default_rng(p)
    x, y = rng.normal(size=(80, 4)), rng.normal(size=(400, 4))
    found = knn.nearest_neighbours(frame(spark, x, "q"), frame(spark, y, "t"), 6, "q", "t", p=p, block=64)
    assert lists(found, "q") == brute_force(x, y, 6, p)


def test_neighbours_with_a_third_of_copies_and_itself_left_out(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 2)), 1)
    x[::3] = [0.5, 0.5]
    rows = frame(spark, x, "t")
    found = knn.nearest_neighbours(
        rows.withColumnRenamed("t", "q"), rows, 4, "q", "t", exclude_self=True, block=32)
    assert lists(found, "q") == brute_force(x, x, 4, 2, exclude_self=True)


def test_fewer_training_rows_than_k(spark):
    x = np.array([[0.0], [1.0], [5.0]])
    rows = frame(spark, x, "t")
    found = knn.nearest_neighbours(rows.withColumnRenamed("t", "q"), rows, 10, "q", "t")
    assert lists(found, "q") == {0: [0, 1, 2], 1: [1, 0, 2], 2: [2, 1, 0]}


def test_weights_and_votes(spark):
    near = spark.createDataFrame(
        [(0, 1, 0.0, 1), (0, 2, 2.0, 2), (1, 1, 1.0, 1), (1, 2, 2.0, 2)], "q long, train_id long, distance double, rank long")
    train = spark.createDataFrame([(1, 10.0), (2, 40.0)], "t long, y double")
    mean = {r["q"]: r["predicted"] for r in knn.knn_regress(near, train, "q", "t", "y").collect()}
    weighted = {r["q"]: r["predicted"] for r in knn.knn_regress(near, train, "q", "t", "y", "distance").collect()}
    assert mean == {0: 25.0, 1: 25.0}
    assert weighted == pytest.approx({0: 10.0, 1: 20.0})
    votes = {r["q"]: r["predicted"] for r in knn.knn_classify(near, train, "q", "t", "y").collect()}
    assert votes == {0: 10.0, 1: 10.0}


def test_error_by_k(spark):
    near = spark.createDataFrame([(0, 1, 1.0, 1), (0, 2, 2.0, 2)], "q long, train_id long, distance double, rank long")
    train = spark.createDataFrame([(1, 10.0), (2, 40.0)], "t long, y double")
    queries = spark.createDataFrame([(0, 20.0)], "q long, y double")
    found = {r["k"]: r["mse"] for r in knn.knn_error_by_k(near, queries, train, "q", "t", "y").collect()}
    assert found == {1: 100.0, 2: 25.0}


def test_zero_count_gives_zero_probability(spark):
    rows = spark.createDataFrame([("a", "x", "yes"), ("a", "x", "yes"), ("b", "x", "no"), ("b", "y", "no")], "f string, g string, c string")
    model = bayes.CategoricalBayes(rows, ["f", "g"], "c")
    asked = spark.createDataFrame([(1, "a", "x"), (2, "a", "y"), (3, "never", "x")], "id int, f string, g string")
    got = {r["id"]: (r["predicted"], r["probability"]) for r in model.predict(asked, ["id"]).collect()}
    assert got == {1: ("yes", 1.0), 2: (None, None), 3: (None, None)}
    smooth = bayes.CategoricalBayes(rows, ["f", "g"], "c", smoothing=1.0).predict(asked, ["id"])
    assert all(r["predicted"] in ("yes", "no") and 0 < r["probability"] < 1 for r in smooth.collect())


def test_gradient_descent_reaches_least_squares(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 2))
    y = 3 + 2 * x[:, 0] - x[:, 1] + rng.normal(scale=0.1, size=500)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, y double")
    exact = np.linalg.lstsq(np.column_stack([np.ones(500), x]), y, rcond=None)[0]
    assert linear.batch_gradient_descent(df, ["a", "b"], "y") == pytest.approx(exact.tolist(), abs=1e-6)
    found = linear.stochastic_gradient_descent(df, ["a", "b"], "y", rate=0.05, batch=4)
    assert found.converged and 1 < found.rounds < 200
    assert found.coefficients == pytest.approx(exact.tolist(), abs=1e-6)
    assert not linear.stochastic_gradient_descent(df, ["a", "b"], "y", rate=0.001, most_rounds=2).converged
    assert linear.stochastic_gradient_descent(df.limit(0), ["a", "b"], "y").coefficients == [0.0, 0.0, 0.0]
    table = {r["term"]: r for r in linear.least_squares_table(df, ["a", "b"], "y", intercept=True).collect()}
    assert table["a"]["coefficient"] == pytest.approx(exact[1]) and table["a"]["p"] < 1e-9


def test_residuals(spark):
    df = spark.createDataFrame([(3.0, 1.0)], "y double, p double")
    assert evaluate.with_residual(df, "y", "p").first()["residual"] == 2.0


def test_own_stages_keep_their_categories_and_can_be_saved(spark, tmp_path):
    train = spark.createDataFrame([(30,), (45,), (71,), (None,)], "age int")
    chain = Pipeline(stages=[AgeClasses(inputCol="age", outputCol="c"), Indicators(inputCol="c", outputCol="v", dropFirst=True)]).fit(train)
    test = spark.createDataFrame([(45,), (72,), (30,)], "age int")
    want = chain.transform(test)
    assert want.columns == ["c", "v"] and [r["v"].toArray().tolist() for r in want.collect()] == [[0, 0], [1, 0], [0, 1]]
    assert chain.stages[1].categories(spark) == ["70_above", "below_40"]
    chain.save(str(tmp_path / "chain"))
    assert PipelineModel.load(str(tmp_path / "chain")).transform(test).collect() == want.collect()


def test_very_many_categories(spark):
    df = spark.range(100_000).select(F.concat(F.lit("c"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("c"))
    model = Indicators(inputCol="c").fit(df)
    got = model.transform(spark.createDataFrame([("c000007",), ("new",), (None,), ("c099999",)], "c string")).collect()
    assert [(r["indicators"].size, r["indicators"].indices.tolist()) for r in got] == [
        (100_000, [7]), (100_000, []), (100_000, []), (100_000, [99_999])]
    empty = Indicators(inputCol="c").fit(df.limit(0)).transform(df.limit(1)).first()
    assert empty["indicators"].size == 0


def test_codes_learned_once_apply_to_new_rows(spark):
    train = spark.createDataFrame([("b",), ("b",), ("a",), ("c",)], "v string")
    test = spark.createDataFrame([("a",), ("new",)], "v string")
    by_count = feat.apply_codes(test, "v", feat.learn_codes(train, "v"), "code")
    assert {r["v"]: r["code"] for r in by_count.collect()} == {"a": 1, "new": None}
    by_value = feat.apply_codes(train, "v", feat.learn_codes(train, "v", by="value"), "code")
    assert {r["v"]: r["code"] for r in by_value.collect()} == {"a": 0, "b": 1, "c": 2}


def test_scaling_of_a_constant_column(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert [r["x"] for r in feat.learn_standard(df, ["x"]).apply(df).collect()] == [0.0, 0.0]


def test_model_predictions_beat_the_majority_and_repeat(spark, sf_dir):
    from __spark_entry__ import queries

    query = queries()["l02_forest_regression"]
    rows = query(spark, sf_dir)
    mean_only = rows.agg(F.var_pop("occupancy")).first()[0]
    mse = evaluate.mean_squared_error(rows, "occupancy", "prediction").first()["mse"]
    assert mse < mean_only / 2
    again = query(spark, sf_dir).agg(F.sum("prediction")).first()[0]
    assert again == pytest.approx(rows.agg(F.sum("prediction")).first()[0])


def test_class_probabilities_sum_to_one(spark, sf_dir):
    from __spark_entry__ import queries

    rows = queries()["l18_model_scoring"](spark, sf_dir)
    off = rows.filter(F.abs(F.col("probability_0") + F.col("probability_1") - 1) > 1e-9)
    assert off.count() == 0


@pytest.fixture(scope="module")
def run(spark, sf_dir):
    from __spark_entry__ import queries

    return lambda name: queries()[name](spark, sf_dir)


@pytest.mark.parametrize("name, label", [
    ("l01_logistic_regression", "low_label"), ("l03_forest_classification", "label"),
    ("l04_tree_classification", "label"), ("l05_boosted_trees", "low_label")])
def test_classifiers_beat_the_largest_class(run, name, label):
    rows = run(name)
    n = rows.count()
    largest = rows.groupBy(label).count().agg(F.max("count")).first()[0] / n
    right = evaluate.accuracy(rows, label, "prediction").first()["accuracy"]
    assert right > largest
    assert rows.filter((F.col("probability") <= 0) | (F.col("probability") > 1 + 1e-9)).isEmpty()


def test_clusters_use_every_number(run):
    rows = run("l17_k_means")
    assert rows.select("cluster_of_8").distinct().count() == 8
    assert rows.select("cluster_of_2").distinct().count() == 2


def test_more_clusters_cost_less(run):
    """Up to the local minima that k-means ends in."""
    rows = run("h07_elbow").orderBy("k").collect()
    costs = [r["cost"] for r in rows]
    assert [r["k"] for r in rows] == list(range(4, 20))
    assert all(b <= 1.01 * a for a, b in zip(costs, costs[1:])) and costs[-1] < 0.97 * costs[0]


def test_penalty_paths_meet_their_conditions(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 3)) * [1.0, 5.0, 0.2] + [0.0, 3.0, 9.0]
    y = 4 + x @ [2.0, -0.3, 1.0] + x[:, 0] * 0.3 + rng.normal(size=400)
    df = spark.createDataFrame([(*map(float, r), float(t), 1.0, i % 5) for i, (r, t) in enumerate(zip(x, y))], "a double, b double, c double, y double, one double, f int")
    names = ["a", "b", "c", "one"]  # the last is constant
    folds = linear.moments_by_fold(df, names, "y", "f")
    whole = linear.moments_by_fold(df, names, "y")[None]
    assert sum(m.n for m in folds.values()) == whole.n == 400
    z = (x - x.mean(0)) / x.std(0)
    for penalty, fit in linear.penalty_path(whole, [0.0, 0.05, 0.5, 50.0]).items():
        beta = fit.coefficients[:3] * x.std(0)
        pull = z.T @ (y - y.mean() - z @ beta) / 400
        for b, g in zip(beta, pull):  # at the minimum the pull equals the penalty, or is below it where the coefficient is 0
            assert abs(g - np.sign(b) * penalty) < 1e-7 if b else abs(g) <= penalty + 1e-9
        assert fit.coefficients[3] == 0 and fit.mse(whole) == pytest.approx(np.mean((y - fit.intercept - x @ fit.coefficients[:3]) ** 2))
    for penalty, fit in linear.penalty_path(whole, [0.0, 10.0], "ridge").items():
        beta = np.linalg.solve(z.T @ z + penalty * np.eye(3), z.T @ (y - y.mean()))
        assert fit.coefficients[:3] * x.std(0) == pytest.approx(beta)
    for penalty, fold, train_error, error in linear.penalty_search(folds, [0.05], "lasso"):
        held = np.arange(400) % 5 == fold
        fit = linear.penalty_path(linear.moments_by_fold(df.filter(F.col("f") != fold), names, "y")[None], [0.05])[0.05]
        assert error == pytest.approx(np.mean((y - fit.intercept - x @ fit.coefficients[:3])[held] ** 2))
        assert train_error == pytest.approx(np.mean((y - fit.intercept - x @ fit.coefficients[:3])[~held] ** 2))


def test_lasso_and_ridge_shrink(run):
    rows = run("l16_lasso_and_ridge").filter("term <> 'intercept'")
    for kind in ("lasso", "ridge"):
        sizes = [r["s"] for r in rows.filter(F.col("kind") == kind).groupBy("penalty").agg(F.sum(F.abs("coefficient")).alias("s")).orderBy("penalty").collect()]
        assert len(sizes) == 13 and sizes == sorted(sizes, reverse=True)


def test_bayes_stays_finite(spark):
    """A class of one row, a constant column, a column constant within a class, and fifty columns."""
    rng = np.random.default_rng(2)
    rows = [("a", *rng.normal(size=50)) for _ in range(30)] + [("b", *(rng.normal(size=50) + 3)) for _ in range(30)] + [("c", *[9.0] * 50)]
    rows = [(r[0], 1.0, 5.0 if r[0] == "a" else float(i), *map(float, r[1:])) for i, r in enumerate(rows)]
    names = ["same", "half", *[f"x{i}" for i in range(50)]]
    df = spark.createDataFrame(rows, f"k string, {', '.join(f'{n} double' for n in names)}")
    got = bayes.GaussianBayes(df, names, "k").predict(df, ["k"]).collect()
    assert all(r["predicted"] == r["k"] and 0 < r["probability"] <= 1 for r in got)
    many = spark.createDataFrame([(*[f"v{(i * j) % 7}" for j in range(60)], "yes" if i % 3 else "no") for i in range(90)], ", ".join([*[f"c{j} string" for j in range(60)], "y string"]))
    got = bayes.CategoricalBayes(many, [f"c{j}" for j in range(60)], "y", 0.01).predict(many, ["y"]).collect()
    assert all(0 < r["probability"] <= 1 for r in got) and len(got) == 90


def test_long_value_tables_are_joined_salted(spark, monkeypatch):
    df = spark.range(600).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("v"), (F.col("id") % 2).alias("y"))
    model = bayes.CategoricalBayes(df, ["v"], "y", 1.0)
    want = {tuple(r) for r in model.predict(df, ["id"]).collect()}
    monkeypatch.setattr(bayes, "BROADCAST_VALUES", 5)
    assert {tuple(r) for r in model.predict(df, ["id"]).collect()} == want and len(want) == 600


def test_multinomial_bayes_equals_the_library(spark):
    """With classes of one size, as the library smooths their shares too."""
    from pyspark.ml.classification import NaiveBayes

    rng = np.random.default_rng(4)
    terms = ["a", "b", "c", "d"]
    rows = [(i, i % 2, [(t, float(w)) for t, w in zip(terms, rng.random(4) + (i % 2) * np.array([1, 0, 0, 1])) if w > 0.2]) for i in range(80)]
    rows += [(98, 0, []), (99, 1, [])]
    df = spark.createDataFrame(rows, "id int, y int, terms array<struct<term:string,weight:double>>")
    got = {r["id"]: r for r in bayes.MultinomialBayes(df, "y", terms).predict(df, ["id"]).collect()}
    wide = feat.weight_vectors(df, terms)
    for r in NaiveBayes(labelCol="y", modelType="multinomial").fit(wide).transform(wide).collect():
        assert got[r["id"]]["probability"] == pytest.approx(max(r["probability"]), abs=1e-9)
        if abs(r["probability"][0] - 0.5) > 1e-2:
            assert got[r["id"]]["predicted"] == int(r["prediction"])


@pytest.mark.parametrize("p", [1, 2])
def test_hash_tables_find_the_near_ones_at_any_size(spark, p):
    """The number of rows met stays flat when the table grows tenfold, and at least 0.95 of the ten nearest are found."""
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(4000, 24)) * 3
    met = []
    for n in (2000, 20_000):
        x = centres[rng.integers(0, len(centres) * n // 20_000, n)] + rng.normal(size=(n, 24)) * 0.3
        asked = x[:: n // 100]
        train, queries = frame(spark, x, "t"), frame(spark, asked, "q")
        found = lists(knn.hashed_neighbours(queries, train, 10, "q", "t", p=p, bucket=128), "q")
        want = brute_force(asked, x, 10, p)
        assert np.mean([len(set(found[i]) & set(want[i])) / 10 for i in want]) >= 0.95
        hashed = knn.ProjectionTables(train, "features", n, bucket=128)
        cells = hashed.placed(train, "features").groupBy("cell").count()
        met.append(hashed.placed(queries, "features", 8).join(cells, "cell").agg(F.sum("count")).first()[0] / len(asked))
    assert met[1] <= 1.1 * met[0]


def test_hash_tables_answer_all_queries(spark):
    """Copies of one vector, fewer rows than asked for, and far queries are answered as by the exact form."""
    x = np.concatenate([np.zeros((900, 3)), np.random.default_rng(1).normal(size=(30, 3))])
    rows = frame(spark, x, "t")
    far = frame(spark, np.array([[100.0, 0, 0], [0, 0, 0]]), "q")
    got = lists(knn.hashed_neighbours(far, rows, 5, "q", "t", tables=1, probes=1, bucket=4), "q")
    assert set(got) == {0, 1} and all(len(v) == 5 for v in got.values()) and got[1] == [0, 1, 2, 3, 4]


def test_tree_cut_at_every_depth(run, spark, sf_dir):
    """The curve of the cut tree equals trees grown to each depth."""
    from pyspark.ml.classification import DecisionTreeClassifier

    from brightloom.operators import ranking
    from brightloom.plans.models import vectors

    curve = {r["depth"]: r for r in run("h01_error_by_depth").collect()}
    df = ranking.hash_split(vectors(spark, sf_dir), "vec_id", 70).persist()
    for depth in (1, 3):
        model = DecisionTreeClassifier(maxDepth=depth, seed=7).fit(df.filter("split = 'train'"))
        for part in ("train", "test"):
            rows = model.transform(df.filter(F.col("split") == part))
            assert curve[depth][part] == pytest.approx(rows.filter("prediction <> label").count() / rows.count())
    df.unpersist()


def test_best_parameters_have_the_best_mean(run):
    table = run("h03_grid_search").collect()
    assert len(table) == 19 * 4
    best = min(table, key=lambda r: (-r["mean"], r["depth"], r["features"]))
    row = run("h08_best_parameters").first()
    assert (row["depth"], row["features"]) == (best["depth"], best["features"])


def test_components_are_centred_and_ordered(run):
    row = run("m11_principal_components").agg(
        F.avg("first").alias("m"), F.var_samp("first").alias("a"), F.var_samp("second").alias("b")).first()
    assert abs(row["m"]) < 1e-6 and row["a"] >= row["b"] > 0


def test_deeper_trees_fit_the_training_rows_better(run):
    rows = run("h06_validation_curve").orderBy("value").collect()
    assert len(rows) == 19 and [r["train"] for r in rows] == sorted(r["train"] for r in rows)
    assert all(r["train"] >= r["validation"] for r in rows)


def test_stream_scores_equal_table_scores(spark, sf_dir):
    from brightloom.plans import streams
    from brightloom.streaming import scoring

    model = streams.sensor_model(spark, sf_dir)
    table = streams.sensor_rows(streams.table(spark, sf_dir, "events"))
    want = scoring.score(model, table, ["event_id", "occupancy"])
    got = streams.score_stream(spark, sf_dir)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    confusion = {(r["occupancy"], r["predicted"]): r["n"] for r in streams.running_confusion(spark, sf_dir).collect()}
    assert confusion == {
        (r["occupancy"], r["predicted"]): r["n"] for r in scoring.running_confusion(want, "occupancy").collect()}
