"""Feature preparation and the surface for own functions and stages."""

from __future__ import annotations

import pandas as pd
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F, types as T

from brightloom.functions import numeric
from brightloom.operators import features as feat, graph, ranking
from brightloom.operators.stages import AgeClasses, Indicators
from brightloom.plans.aggregation import HASH_SQL
from brightloom.plans.column_operations import K_SQL, events_k
from brightloom.plans.functions_text import clean_words_sql
from brightloom.plans.graphs import SUPPLY_SQL, supply_edges
from brightloom.plans.registry import dealt, query, table


@query("m01_codes_by_frequency", sql="""
    SELECT p_partkey, b.code AS brand_code, t.code AS type_code FROM part
    JOIN (SELECT p_brand, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS code FROM part GROUP BY p_brand) b USING (p_brand)
    JOIN (SELECT p_type, row_number() OVER (ORDER BY count(*) DESC, p_type) - 1 AS code FROM part GROUP BY p_type) t USING (p_type)""")
def codes_by_frequency(spark, sf_dir):
    out = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    for column, name in (("p_brand", "brand_code"), ("p_type", "type_code")):
        out = feat.apply_codes(out, column, feat.learn_codes(out, column), name)
    return out.select("p_partkey", "brand_code", "type_code")


@query("m02_codes_by_value", sql="""
    SELECT o_orderkey, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS priority_code FROM orders""")
def codes_by_value(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    codes = feat.learn_codes(orders, "o_orderpriority", by="value")
    return feat.apply_codes(orders, "o_orderpriority", codes, "priority_code").select("o_orderkey", "priority_code")


def named_indicators(df, column, drop_first=False):
    """The learned indicator vector taken apart into a column for each category."""
    model = Indicators(inputCol=column, dropFirst=drop_first).fit(df)
    cells = vector_to_array("indicators")
    names = model.categories(df.sparkSession)
    return model.transform(df).select(*df.columns, *[cells[i].cast("int").alias(f"{column}_{v}") for i, v in enumerate(names)])


@query("m03_indicator_columns", sql="""
    SELECT o_orderkey, CAST(o_orderstatus = 'O' AS INTEGER) AS "o_orderstatus_O", CAST(o_orderstatus = 'P' AS INTEGER) AS "o_orderstatus_P"
    FROM orders""")
def indicator_columns(spark, sf_dir):
    """The first category is left out."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    return named_indicators(orders, "o_orderstatus", drop_first=True).drop("o_orderstatus")


LINE_FEATURES = ["l_quantity", "l_extendedprice", "l_discount"]


@query("m04_assemble_vector", sql="""
    SELECT l_orderkey, l_linenumber, concat_ws(' ', l_quantity, l_extendedprice, l_discount) AS features FROM lineitem""")
def assemble_vector(spark, sf_dir):
    out = feat.assemble(LINE_FEATURES).transform(table(spark, sf_dir, "lineitem"))
    return out.select(
        "l_orderkey", "l_linenumber",
        F.array_join(vector_to_array("features").cast("array<string>"), " ").alias("features"))


@query("m05_standardise", sql="""
    SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 6) AS o_totalprice FROM orders""")
def standardise(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return feat.learn_standard(orders, ["o_totalprice"]).apply(orders).withColumn("o_totalprice", F.round("o_totalprice", 6))


@query("m06_min_max", sql="""
    SELECT c_custkey, round((c_acctbal - min(c_acctbal) OVER ()) / (max(c_acctbal) OVER () - min(c_acctbal) OVER ()), 9) AS c_acctbal
    FROM customer""")
def min_max(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return feat.learn_min_max(customers, ["c_acctbal"]).apply(customers).withColumn("c_acctbal", F.round("c_acctbal", 9))


@query("m07_mean_imputation", sql="""
    SELECT event_id, round(coalesce(v, avg(v) OVER ()), 6) AS v FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)""")
def mean_imputation(spark, sf_dir):
    """Values of error events count as missing."""
    df = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"))
    return feat.impute_means(df, ["v"]).withColumn("v", F.round("v", 6))


@query("m08_chained_preparation", sql=f"""
    WITH r AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v, CAST({K_SQL} AS DOUBLE) AS k FROM events),
    f AS (SELECT event_id, coalesce(v, avg(v) OVER ()) AS v, k FROM r)
    SELECT event_id, round((v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()), 6) AS v,
           round((k - min(k) OVER ()) / (max(k) OVER () - min(k) OVER ()), 6) AS k FROM f""")
def chained_preparation(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") != "error", F.col("value")).alias("v"), events_k().cast("double").alias("k"))
    scaled = vector_to_array("scaled")
    return feat.impute_and_scale(["v", "k"]).fit(df).transform(df).select(
        "event_id", F.round(scaled[0], 6).alias("v"), F.round(scaled[1], 6).alias("k"))


COUNTS_SQL = f"""
    words AS MATERIALIZED (SELECT doc_id, {clean_words_sql('text')} AS w FROM documents),
    counts AS MATERIALIZED (SELECT doc_id, term, count(*) AS n FROM (
        SELECT doc_id, unnest(w) AS term FROM words
        UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words)
        GROUP BY doc_id, term),
    vocabulary AS MATERIALIZED (SELECT term, sum(n) AS total, count(*) AS n_texts FROM counts GROUP BY term ORDER BY total DESC, term LIMIT 100)"""


@query("m09_term_counts", sql=f"WITH {COUNTS_SQL} SELECT doc_id, term, n FROM counts JOIN vocabulary USING (term)")
def term_counts(spark, sf_dir):
    """Counts of the hundred most frequent words and word pairs in each document."""
    counts = feat.term_counts(dealt(spark, sf_dir, "documents"), "doc_id", "text")
    top = [r["term"] for r in feat.top_terms(counts, 100).collect()]
    return counts.select("doc_id", F.inline(F.filter("terms", lambda x: x["term"].isin(top))))


@query("m10_tfidf", sql=f"""
    WITH {COUNTS_SQL}, raw AS (
        SELECT doc_id, term, n * (ln((1.0 + (SELECT count(*) FROM documents)) / (1 + n_texts)) + 1) AS raw
        FROM counts JOIN vocabulary USING (term))
    SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""")
def tfidf(spark, sf_dir):
    counts = feat.term_counts(dealt(spark, sf_dir, "documents"), "doc_id", "text")
    weights = feat.tfidf(counts, feat.top_terms(counts, 100), counts.count())
    return weights.select("doc_id", F.inline("terms")).withColumn("weight", F.round("weight", 6))


@query("m11_principal_components")
def principal_components(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"))
    parts = vector_to_array("components")
    return feat.centred_pca("features", 2, "components").fit(df).transform(df).select(
        "vec_id", parts[0].alias("first"), parts[1].alias("second"))


@query("m11_two_columns", sql="""
    WITH m AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) / 1000 AS my, var_samp(l_quantity) AS a,
        var_samp(l_extendedprice) / 1e6 AS b, covar_samp(l_quantity, l_extendedprice) / 1000 AS c FROM lineitem),
    t AS (SELECT *, atan2(2 * c, a - b) / 2 AS t FROM m)
    SELECT l_orderkey, l_linenumber, round(abs(cos(t) * (l_quantity - mx) + sin(t) * (l_extendedprice / 1000 - my)), 6) AS first,
        round(abs(cos(t) * (l_extendedprice / 1000 - my) - sin(t) * (l_quantity - mx)), 6) AS second FROM lineitem, t""")
def two_columns(spark, sf_dir):
    """Components of two columns: the distance along and across the main axis of their ellipse."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").cast("double").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"))
    df = feat.assemble(["x", "y"]).transform(lines)
    parts = vector_to_array("components")
    return feat.centred_pca("features", 2, "components").fit(df).transform(df).select(
        "l_orderkey", "l_linenumber", F.round(F.abs(parts[0]), 6).alias("first"), F.round(F.abs(parts[1]), 6).alias("second"))


@query("m12_random_split", sql=f"""
    SELECT o_orderkey, CASE WHEN floor({HASH_SQL.format(key='o_orderkey')} / 65536) % 100 < 80 THEN 'train' ELSE 'test' END AS split FROM orders""")
def random_split(spark, sf_dir):
    """All rows, four fifths tagged train."""
    return ranking.hash_split(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", 80)


@query("m13_tagged_split", sql="""
    SELECT split, count(*) AS n, round(avg(balance), 6) AS balance FROM (
        SELECT 'train' AS split, c_acctbal AS balance FROM customer UNION ALL SELECT 'test', s_acctbal FROM supplier) GROUP BY split""")
def tagged_split(spark, sf_dir):
    """Two tables stacked with a tag and taken apart again by it."""
    both = table(spark, sf_dir, "customer").select(F.lit("train").alias("split"), F.col("c_acctbal").alias("balance")).union(
        table(spark, sf_dir, "supplier").select(F.lit("test"), "s_acctbal"))
    parts = [both.filter(F.col("split") == tag) for tag in ("train", "test")]
    summary = [p.groupBy("split").agg(F.count("*").alias("n"), F.round(F.avg("balance"), 6).alias("balance")) for p in parts]
    return summary[0].union(summary[1])


@query("m14_leading_ones", sql="SELECT CAST(1.0 AS DOUBLE) AS ones, c_custkey, c_acctbal FROM customer")
def leading_ones(spark, sf_dir):
    return feat.with_ones(table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal"))


def _nearest_class(x: pd.Series) -> pd.Series:
    return (x + 0.5).floordiv(1).clip(0, 3).astype("int64")


@query("x01_typed_scalar_function", sql="""
    SELECT event_id, CAST(CASE WHEN x < 0.5 THEN 0 WHEN x < 1.5 THEN 1 WHEN x < 2.5 THEN 2 ELSE 3 END AS BIGINT) AS class
    FROM (SELECT event_id, value / 50 AS x FROM events)""")
def typed_scalar_function(spark, sf_dir):
    """The class rounding as an own function over Arrow batches; must equal the expression."""
    nearest = numeric.typed_scalar(_nearest_class, T.LongType())
    return table(spark, sf_dir, "events").select("event_id", nearest(F.col("value") / 50).alias("class"))


AGE_SQL = "CASE WHEN k > 40 AND k <= 49 THEN '40_49' WHEN k > 50 AND k <= 59 THEN '50_59' WHEN k > 60 AND k <= 69 THEN '60_69' WHEN k > 70 THEN '70_above' ELSE 'below_40' END"


@query("x02_own_transformer", sql=f"""
    SELECT event_id, {AGE_SQL} AS age_class FROM (SELECT event_id, {K_SQL} AS k FROM events)""")
def own_transformer(spark, sf_dir):
    df = table(spark, sf_dir, "events").select("event_id", events_k().alias("age"))
    return AgeClasses(inputCol="age", outputCol="age_class").transform(df)


@query("x03_learned_indicators", sql=f"""
    SELECT event_id, """ + ", ".join(
        f"CAST(a = '{c}' AS INTEGER) AS \"age_class_{c}\"" for c in ["40_49", "50_59", "60_69", "70_above", "below_40"]) + f"""
    FROM (SELECT event_id, {AGE_SQL} AS a FROM (SELECT event_id, {K_SQL} AS k FROM events))""")
def learned_indicators(spark, sf_dir):
    df = own_transformer(spark, sf_dir)
    return named_indicators(df, "age_class").drop("age_class")


CHAIN_SQL = f"""
    WITH r AS (SELECT event_id, event_type = 'error' AS y, {HASH_SQL.format(key='event_id')} // 65536 % 100 < 80 AS train,
        {AGE_SQL} AS age_class FROM (SELECT event_id, event_type, {K_SQL} AS k FROM events)),
    p AS (SELECT age_class, avg(CAST(y AS INTEGER)) FILTER (train) AS p FROM r GROUP BY age_class)
    SELECT event_id, CASE WHEN train THEN 'train' ELSE 'test' END AS split, round(p, 4) AS probability FROM r JOIN p USING (age_class)"""


@query("m08_whole_chain", sql=CHAIN_SQL)
def whole_chain(spark, sf_dir):
    """Own stages, indicators, assembly and a logistic regression as one fitted chain; with indicators alone it gives the shares of the classes."""
    df = ranking.hash_split(table(spark, sf_dir, "events").select(
        "event_id", events_k().alias("age"), (F.col("event_type") == "error").cast("double").alias("label")), "event_id", 80)
    chain = Pipeline(stages=[
        AgeClasses(inputCol="age", outputCol="age_class"), Indicators(inputCol="age_class", dropFirst=True),
        feat.assemble(["indicators"]), LogisticRegression(tol=1e-12, maxIter=200)])
    model = chain.fit(df.filter("split = 'train'"))
    return model.transform(df).select("event_id", "split", F.round(vector_to_array("probability")[1], 4).alias("probability"))


@query("x04_apply_python_function", sql="""
    SELECT conv_id, turn, len(text) AS n_chars FROM conversations""")
def apply_python_function(spark, sf_dir):
    """A Python function over batches of rows."""
    def lengths(batches):
        for rows in batches:
            yield rows[["conv_id", "turn"]].assign(n_chars=rows["text"].str.len())

    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "text").mapInPandas(
        lengths, "conv_id bigint, turn bigint, n_chars bigint")


@query("x05_several_rows_per_row", sql=f"""
    WITH {SUPPLY_SQL}, links AS (SELECT src, dst, count(*) OVER (PARTITION BY src) AS n FROM edges)
    SELECT dst AS id, round(sum(1.0::DOUBLE / n), 9) AS part FROM links GROUP BY dst""")
def several_rows_per_row(spark, sf_dir):
    """Each row of the link table gives one row per target; here with rank 1 for every page."""
    edges = supply_edges(spark, sf_dir)
    ranks = graph.vertices(edges).select("id", F.lit(1.0).alias("rank"))
    parts = graph.contributions(graph.adjacency(edges), ranks)
    return parts.groupBy("id").agg(F.round(F.sum("part"), 9).alias("part"))
