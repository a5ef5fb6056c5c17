"""Aggregation, ranking and sorting."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.operators import aggregates as agg, evaluate, knn, ranking
from brightloom.plans.column_operations import RETURNS_SQL, returns, rule_conditions
from brightloom.plans.joins_sets import embedding_neighbours, pairs_sql
from brightloom.plans.registry import query, table

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a01_row_count", sql="SELECT count(*) AS n FROM lineitem")
def row_count(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.count("*").alias("n"))


@query("a02_filtered_mean", sql="SELECT round(avg(value), 6) AS mean FROM events WHERE value > 32")
def filtered_mean(spark, sf_dir):
    return table(spark, sf_dir, "events").filter(F.col("value") > 32).agg(F.round(F.avg("value"), 6).alias("mean"))


@query("a03_filtered_group_count", sql="""
    SELECT c_nationkey, count(*) AS n FROM customer WHERE c_mktsegment = 'BUILDING' GROUP BY c_nationkey""")
def filtered_group_count(spark, sf_dir):
    return table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING").groupBy("c_nationkey").agg(
        F.count("*").alias("n"))


@query("a04_group_average", sql="""
    SELECT n_name, round(avg(c_acctbal), 6) AS average FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name ORDER BY average DESC, n_name""")
def group_average(spark, sf_dir):
    joined = table(spark, sf_dir, "customer").join(
        table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return agg.group_average(joined, ["n_name"], "c_acctbal", "average").withColumn("average", F.round("average", 6))


@query("a05_sum_by_key", sql="SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey")
def sum_by_key(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"))


@query("a06_sorted_list_per_key", sql="""
    SELECT l_suppkey, CAST(floor(pos / 100) AS BIGINT) AS block, string_agg(CAST(l_partkey AS VARCHAR), ' ' ORDER BY l_partkey) AS parts
    FROM (SELECT l_suppkey, l_partkey, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_partkey) - 1 AS pos
          FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)) GROUP BY l_suppkey, block""")
def sorted_list_per_key(spark, sf_dir):
    return agg.posting_blocks(table(spark, sf_dir, "lineitem"), "l_suppkey", "l_partkey", block=100).select(
        "l_suppkey", "block", F.array_join(F.col("values").cast("array<string>"), " ").alias("parts"))


@query("a07_distinct_rows", sql="SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct_rows(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber").distinct()


@query("a08_distinct_by_column", sql="""
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1""")
def distinct_by_column(spark, sf_dir):
    """The earliest order of each customer survives."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate")
    return agg.first_per_key(orders, ["o_custkey"], [F.col("o_orderdate"), F.col("o_orderkey")]).drop("o_orderdate")


@query("a09_having", sql="SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 15")
def having(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n")).filter(F.col("n") > 15)


@query("a10_value_frequencies", sql="""
    SELECT 'p_brand' AS "column", p_brand AS value, count(*) AS n FROM part GROUP BY p_brand
    UNION ALL SELECT 'p_type', p_type, count(*) FROM part GROUP BY p_type
    UNION ALL SELECT 'p_size', CAST(p_size AS VARCHAR), count(*) FROM part GROUP BY p_size""")
def value_frequencies(spark, sf_dir):
    return agg.value_counts(table(spark, sf_dir, "part"), ["p_brand", "p_type", "p_size"])


@query("a11_cross_table", sql="""
    SELECT p_brand, count(*) FILTER (p_type = 'ECONOMY') AS p_type_ECONOMY, count(*) FILTER (p_type = 'LARGE') AS p_type_LARGE,
           count(*) FILTER (p_type = 'MEDIUM') AS p_type_MEDIUM, count(*) FILTER (p_type = 'PROMO') AS p_type_PROMO,
           count(*) FILTER (p_type = 'SMALL') AS p_type_SMALL, count(*) FILTER (p_type = 'STANDARD') AS p_type_STANDARD
    FROM part GROUP BY p_brand""")
def cross_table(spark, sf_dir):
    """A column for each category of the data."""
    part = table(spark, sf_dir, "part")
    kinds = [r["p_type"] for r in part.select("p_type").distinct().orderBy("p_type").collect()]  # six fixed kinds of part
    return agg.cross_table(part, "p_brand", "p_type", kinds)


@query("a12_cross_table_margins", sql="""
    SELECT coalesce(o_orderstatus, 'All') AS o_orderstatus, coalesce(o_orderpriority, 'All') AS o_orderpriority, count(*) AS n
    FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""")
def cross_table_margins(spark, sf_dir):
    return agg.cross_table_margins(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderpriority")


@query("a13_null_counts", sql="""
    SELECT count(*) FILTER (o_orderkey IS NULL) AS o_orderkey,
           count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS o_orderpriority FROM orders""")
def null_counts(spark, sf_dir):
    return agg.null_counts(table(spark, sf_dir, "orders").select(
        "o_orderkey", F.nullif("o_orderpriority", F.lit("4-NOT SPECIFIED")).alias("o_orderpriority")))


def _describe_sql(column: str) -> str:
    return (f"SELECT '{column}' AS \"column\", count({column}) AS n, round(avg({column}), 5) AS mean, "
            f"round(var_samp({column}), 3) AS variance, CAST(min({column}) AS DOUBLE) AS min, CAST(max({column}) AS DOUBLE) AS max, "
            f"round(stddev_samp({column}), 5) AS std, round(skewness({column}), 6) AS skew, "
            f"round(median({column}), 6) AS median FROM lineitem")


@query("a14_descriptive_statistics", sql=" UNION ALL ".join(_describe_sql(c) for c in LINE_NUMBERS))
def descriptive_statistics(spark, sf_dir):
    out = agg.describe(table(spark, sf_dir, "lineitem"), LINE_NUMBERS)
    digits = {"mean": 5, "variance": 3, "std": 5, "skew": 6, "median": 6}
    return out.withColumns({c: F.round(c, d) for c, d in digits.items()})


@query("a15_moments_by_class", sql="""
    SELECT l_returnflag, round(avg(l_quantity), 6) AS l_quantity_mean, round(stddev_samp(l_quantity), 6) AS l_quantity_std,
           round(avg(l_discount), 8) AS l_discount_mean, round(stddev_samp(l_discount), 8) AS l_discount_std
    FROM lineitem GROUP BY ROLLUP (l_returnflag)""")
def moments_by_class(spark, sf_dir):
    out = agg.moments_by_class(table(spark, sf_dir, "lineitem"), "l_returnflag", ["l_quantity", "l_discount"])
    return out.select("l_returnflag", *[F.round(c, 6 if "quantity" in c else 8).alias(c) for c in out.columns[1:]])


@query("a16_covariance_matrix", sql=" UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(covar_samp({a}, {b}), 3) AS covariance FROM lineitem"
    for a in LINE_NUMBERS for b in LINE_NUMBERS))
def covariance_matrix(spark, sf_dir):
    return agg.covariance_matrix(table(spark, sf_dir, "lineitem"), LINE_NUMBERS).withColumn(
        "covariance", F.round("covariance", 3))


@query("a17_value_sets", sql="""
    SELECT DISTINCT 'lang' AS "column", lang AS value FROM documents UNION ALL SELECT DISTINCT 'source', source FROM documents""")
def value_sets(spark, sf_dir):
    return agg.distinct_values(table(spark, sf_dir, "documents"), ["lang", "source"])


def _profile_sql(column: str, kind: str) -> str:
    return (f"SELECT '{column}' AS \"column\", '{kind}' AS type, count(*) AS n_rows, count({column}) AS n_present, "
            f"count(DISTINCT {column}) AS n_distinct, CAST(min({column}) AS VARCHAR) AS smallest, "
            f"CAST(max({column}) AS VARCHAR) AS largest, round(avg(CASE WHEN {column} IS NOT NULL THEN p END), 6) AS target_rate "
            "FROM (SELECT *, CAST(p_type = 'PROMO' AS INTEGER) AS p FROM part)")


@query("a18_table_profile", sql=" UNION ALL ".join(_profile_sql(c, k) for c, k in [
    ("p_name", "string"), ("p_brand", "string"), ("p_size", "int"), ("p", "int")]))
def table_profile(spark, sf_dir):
    df = table(spark, sf_dir, "part").select(
        "p_name", "p_brand", "p_size", (F.col("p_type") == "PROMO").cast("int").alias("p"))
    return agg.profile(df, target="p").withColumn("target_rate", F.round("target_rate", 6))


@query("a19_histogram", sql="""
    WITH s AS (SELECT min(value) AS low, (max(value) - min(value)) / 20 AS width FROM events),
         c AS (SELECT CAST(least(floor((value - low) / width), 19) AS BIGINT) AS bin, count(*) AS n FROM events, s GROUP BY 1)
    SELECT b.bin, round(low + b.bin * width, 6) AS low, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(20)) AS bin) b LEFT JOIN c USING (bin), s""")
def histogram(spark, sf_dir):
    return agg.histogram(table(spark, sf_dir, "events"), "value", 20).withColumn("low", F.round("low", 6))


@query("a20_class_priors", sql="""
    SELECT event_type, count(*) AS n, count(*) / sum(count(*)) OVER () AS prior FROM events GROUP BY event_type""")
def class_priors(spark, sf_dir):
    return agg.class_priors(table(spark, sf_dir, "events"), "event_type")


@query("a21_masked_column_means", sql="""
    SELECT round(avg(l_quantity), 6) AS l_quantity, round(avg(l_extendedprice), 4) AS l_extendedprice FROM lineitem
    WHERE l_returnflag = 'R' AND l_discount > 0.05""")
def masked_column_means(spark, sf_dir):
    masked = table(spark, sf_dir, "lineitem").filter((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.05))
    return masked.agg(
        F.round(F.avg("l_quantity"), 6).alias("l_quantity"), F.round(F.avg("l_extendedprice"), 4).alias("l_extendedprice"))


@query("a22_entropy", sql="SELECT round(entropy(event_type), 9) AS entropy FROM events")
def entropy(spark, sf_dir):
    return agg.entropy(table(spark, sf_dir, "events"), "event_type").select(F.round("entropy", 9).alias("entropy"))


def gain_sql(name: str, attribute: str) -> str:
    return f"""
    SELECT '{name}' AS attribute, round((SELECT entropy(cheat) FROM {RETURNS_SQL}) -
        (SELECT sum(h * n) / sum(n) FROM (SELECT entropy(cheat) AS h, count(*) AS n FROM {RETURNS_SQL} GROUP BY {attribute})), 9) AS gain"""


RULE_ATTRIBUTES = ["refund", "marital_status", "income_above_80k"]


@query("a23_information_gain", sql=" UNION ALL ".join(gain_sql(a, a) for a in RULE_ATTRIBUTES))
def information_gain(spark, sf_dir):
    return agg.information_gain(returns(spark, sf_dir), RULE_ATTRIBUTES, "cheat").withColumn("gain", F.round("gain", 9))


@query("a24_gain_one_against_rest", sql=" UNION ALL ".join(
    gain_sql(v, f"marital_status = '{v}'") for v in ["single", "married", "divorced"]))
def gain_one_against_rest(spark, sf_dir):
    one = {v: F.col("marital_status") == v for v in ["single", "married", "divorced"]}
    return agg.information_gain(returns(spark, sf_dir), one, "cheat").withColumn("gain", F.round("gain", 9))


@query("a25_mutual_information", sql=" UNION ALL ".join(
    gain_sql(a, a).replace("9) AS gain", "9) AS gain").replace("round((", "round(ln(2) * ((").replace(
        f"GROUP BY {a})), 9) AS gain", f"GROUP BY {a}))), 9) AS mutual_information") for a in RULE_ATTRIBUTES))
def mutual_information(spark, sf_dir):
    return agg.mutual_information(returns(spark, sf_dir), RULE_ATTRIBUTES, "cheat").withColumn(
        "mutual_information", F.round("mutual_information", 9))


@query("a26_best_row", sql="""
    SELECT arg_min(o_orderkey, (-o_totalprice, o_orderkey)) AS o_orderkey, max(o_totalprice) AS o_totalprice FROM orders""")
def best_row(spark, sf_dir):
    return agg.best_row(table(spark, sf_dir, "orders"), "o_totalprice", "o_orderkey", smallest=False)


@query("a27_metric_table", sql=f"""
    WITH r AS (SELECT CAST(refund = 'no' AND income_above_80k = 'yes' AND marital_status <> 'married' AS INTEGER) AS full_rule,
                      CAST(marital_status <> 'married' AS INTEGER) AS one_rule, CAST(cheat = 'yes' AS INTEGER) AS y FROM {RETURNS_SQL}),
    a AS (SELECT avg(CAST(full_rule = y AS INTEGER)) AS f, avg(CAST(one_rule = y AS INTEGER)) AS o FROM r)
    SELECT 'full rule' AS model, 'all' AS dataset, 'accuracy' AS metric, round(f, 9) AS value FROM a
    UNION ALL SELECT 'full rule', 'all', 'zero_one_loss', round(1 - f, 9) FROM a
    UNION ALL SELECT 'one attribute', 'all', 'accuracy', round(o, 9) FROM a
    UNION ALL SELECT 'one attribute', 'all', 'zero_one_loss', round(1 - o, 9) FROM a""")
def metric_table(spark, sf_dir):
    from brightloom.operators import columns as cols

    rows = returns(spark, sf_dir).select(
        cols.rule_nested(rule_conditions()).alias("full_rule"),
        cols.rule_nested(rule_conditions()[2:]).alias("one_rule"),
        (F.col("cheat") == "yes").cast("int").alias("y"))
    return agg.metric_rows({
        ("full rule", "all"): evaluate.accuracy(rows, "y", "full_rule"),
        ("one attribute", "all"): evaluate.accuracy(rows, "y", "one_rule"),
    }).withColumn("value", F.round("value", 9))


@query("w01_nearest_per_row", sql=f"""
    SELECT query, train, rank FROM {pairs_sql('list_sum(list_transform(list_zip(a.e, b.e), lambda p: abs(p[1] - p[2])))')} WHERE rank <= 5""")
def nearest_per_row(spark, sf_dir):
    """The five nearest other vectors of every vector by Manhattan distance."""
    return embedding_neighbours(spark, sf_dir, 5, p=1).select("query", F.col("train_id").alias("train"), "rank")


def scored_documents(spark, sf_dir):
    """Labelled documents with their length as score and a length rule as prediction."""
    return table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", "quality", "toxic", "n_chars", (F.col("n_chars") > 500).cast("int").alias("predicted"))


SCORED_SQL = """(SELECT doc_id, quality, toxic, n_chars, CAST(n_chars > 500 AS INTEGER) AS predicted
                 FROM labels JOIN documents USING (doc_id))"""


@query("w02_running_true_false", sql=f"""
    SELECT n_chars AS threshold, CAST(sum(sum(quality)) OVER w AS BIGINT) AS tp, CAST(sum(sum(1 - quality)) OVER w AS BIGINT) AS fp
    FROM {SCORED_SQL} GROUP BY n_chars WINDOW w AS (ORDER BY n_chars DESC)""")
def running_true_false(spark, sf_dir):
    return evaluate.roc_points(scored_documents(spark, sf_dir), "quality", "n_chars").select("threshold", "tp", "fp")


@query("w03_ordered_split", sql="""
    SELECT event_id, CASE WHEN row_number() OVER (ORDER BY ts, event_id) <= floor(count(*) OVER () * 0.2) THEN 'test' ELSE 'train' END AS split
    FROM events""")
def ordered_split(spark, sf_dir):
    return ranking.ordered_split(table(spark, sf_dir, "events").select("event_id", "ts"), ["ts", "event_id"], 0.2).select(
        "event_id", "split")


HASH_SQL = "(({key} % 2147483647) * 2654435761) % 4294967296"


@query("w04_folds", sql=f"""
    SELECT doc_id, CAST((row_number() OVER (PARTITION BY quality ORDER BY {HASH_SQL.format(key='doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS fold,
           CAST((row_number() OVER (ORDER BY {HASH_SQL.format(key='doc_id')}, doc_id) - 1) % 5 AS INTEGER) AS plain_fold FROM labels""")
def folds(spark, sf_dir):
    stratified = ranking.stratified_folds(table(spark, sf_dir, "labels"), "quality", "doc_id", 5)
    return ranking.plain_folds(stratified, "doc_id", 5, "plain_fold").select("doc_id", "fold", "plain_fold")


@query("o01_sort_by_key", sql="SELECT c_custkey, c_name FROM customer ORDER BY c_custkey")
def sort_by_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_name").orderBy("c_custkey")


@query("o02_sort_descending_partitions", sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey")
def sort_descending(spark, sf_dir):
    return ranking.sorted_partitions(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), 3, F.desc("o_totalprice"), F.asc("o_orderkey"))


@query("o03_first_rows", sql="SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20")
def first_rows(spark, sf_dir):
    return ranking.first_rows(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), 20, F.asc("o_orderdate"), F.asc("o_orderkey"))


@query("o04_last_rows", sql="SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20")
def last_rows(spark, sf_dir):
    return ranking.first_rows(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), 20, F.desc("o_orderdate"), F.desc("o_orderkey"))


@query("o05_first_distinct_values", sql="""
    SELECT p_brand, min(p_partkey) AS first_at FROM part GROUP BY p_brand ORDER BY first_at LIMIT 5""")
def first_distinct_values(spark, sf_dir):
    return ranking.first_distinct(table(spark, sf_dir, "part"), "p_brand", "p_partkey", 5)


@query("o06_top_by_metric", sql="""
    SELECT l_suppkey, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_suppkey ORDER BY quantity DESC, l_suppkey LIMIT 5""")
def top_by_metric(spark, sf_dir):
    totals = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.sum("l_quantity").alias("quantity"))
    return ranking.first_rows(totals, 5, F.desc("quantity"), F.asc("l_suppkey"))
