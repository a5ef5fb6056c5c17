"""Scalar, string, date, array and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.functions import numeric, text
from brightloom.plans.registry import dealt, query, table


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


STOP_SQL = ", ".join(quoted(w) for w in text.STOP_WORDS)
SPACE_SQL = quoted("[ \\t\\n\\r\\f]+")


def words_sql(column: str) -> str:
    return f"list_filter(regexp_split_to_array({column}, {SPACE_SQL}), lambda w: w <> '')"


def clean_words_sql(column: str) -> str:
    bare = f"translate(lower({column}), {quoted(text.PUNCTUATION)}, '')"
    return (f"list_filter(regexp_split_to_array({bare}, {SPACE_SQL}), "
            f"lambda w: regexp_full_match(w, '\\p{{L}}+') AND w NOT IN ({STOP_SQL}))")


def joined_sql(items: str) -> str:
    return f"array_to_string({items}, ' ')"


@query("f01_split", sql="SELECT p_partkey, string_split(p_name, ' ')[1] AS first_word, len(string_split(p_name, ' ')) AS n FROM part")
def split(spark, sf_dir):
    words = F.split("p_name", " ")
    return table(spark, sf_dir, "part").select(
        "p_partkey", text.head(words).alias("first_word"), F.size(words).cast("bigint").alias("n"))


@query("f02_explode", sql="SELECT unnest(string_split(p_name, ' ')) AS word FROM part")
def explode(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.explode(F.split("p_name", " ")).alias("word"))


@query("f03_explode_with_key", sql=f"""
    SELECT item_id, unnest({words_sql('text')}) AS word FROM benchmark""")
def explode_with_key(spark, sf_dir):
    return table(spark, sf_dir, "benchmark").select("item_id", F.explode(text.words(F.col("text"))).alias("word"))


@query("f04_sorted_unique_list", sql=f"""
    SELECT conv_id, turn, {joined_sql(f"list_sort(list_distinct({words_sql('text')}))")} AS vocabulary FROM conversations""")
def sorted_unique_list(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(text.sorted_unique(text.words(F.col("text"))), " ").alias("vocabulary"))


@query("f05_head_rest_size", sql=f"""
    SELECT item_id, w[1] AS head, {joined_sql('w[2:]')} AS rest, len(w) AS n
    FROM (SELECT item_id, {words_sql('text')} AS w FROM benchmark)""")
def head_rest_size(spark, sf_dir):
    w = text.words(F.col("text"))
    return table(spark, sf_dir, "benchmark").select(
        "item_id", text.head(w).alias("head"), F.array_join(text.rest(w), " ").alias("rest"),
        F.size(w).cast("bigint").alias("n"))


@query("f06_trim", sql="""
    SELECT c_custkey, trim('  ' || c_name || ' ') AS plain, trim('"' || c_mktsegment || '"', '"') AS unquoted FROM customer""")
def trim(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.trim(F.concat(F.lit("  "), "c_name", F.lit(" "))).alias("plain"),
        F.btrim(F.concat(F.lit('"'), "c_mktsegment", F.lit('"')), F.lit('"')).alias("unquoted"))


@query("f07_lower", sql="SELECT conv_id, turn, lower(text) AS text FROM conversations")
def lower(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.lower("text").alias("text"))


@query("f08_replace", sql="SELECT p_partkey, replace(p_name, 'ring', 'band') AS p_name FROM part")
def replace(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.replace("p_name", F.lit("ring"), F.lit("band")).alias("p_name"))


@query("f09_translate", sql=f"""
    SELECT doc_id, translate(text, {quoted(text.PUNCTUATION)}, '') AS bare,
           translate(o, {quoted('-' + text.PUNCTUATION.replace('-', ''))}, ' ') AS dashes
    FROM (SELECT doc_id, text, source || '-' || lang || ' (' || n_chars || ')' AS o FROM documents)""")
def translate(spark, sf_dir):
    label = F.concat("source", F.lit("-"), "lang", F.lit(" ("), "n_chars", F.lit(")"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.without_punctuation(F.col("text")).alias("bare"), text.dash_to_space(label).alias("dashes"))


@query("f10_concatenate", sql="""
    SELECT o_orderkey, o_orderstatus || ' ' || p AS null_wins, concat_ws(' ', o_orderstatus, p) AS null_skipped
    FROM (SELECT o_orderkey, o_orderstatus, nullif(o_orderpriority, '5-LOW') AS p FROM orders)""")
def concatenate(spark, sf_dir):
    df = table(spark, sf_dir, "orders").withColumn("p", F.nullif("o_orderpriority", F.lit("5-LOW")))
    return df.select(
        "o_orderkey",
        text.join_columns("o_orderstatus", "p", skip_null=False).alias("null_wins"),
        text.join_columns("o_orderstatus", "p", skip_null=True).alias("null_skipped"))


@query("f11_date_time", sql="SELECT event_id, date_trunc('second', ts) AS at FROM events")
def date_time(spark, sf_dir):
    """Dates and times are first written as strings, the way the sensor files hold them."""
    return table(spark, sf_dir, "events").select(
        "event_id", F.date_format("ts", "yyyy/MM/dd").alias("d"), F.date_format("ts", "HH:mm:ss").alias("t")
    ).select("event_id", text.date_time(F.col("d"), F.col("t")).cast("timestamp_ntz").alias("at"))


@query("f12_clean_long_texts", sql=f"""
    SELECT doc_id, {joined_sql('w')} AS text FROM (SELECT doc_id, {clean_words_sql('text')} AS w FROM documents) WHERE len(w) > 50""")
def clean_long_texts(spark, sf_dir):
    documents = dealt(spark, sf_dir, "documents").select("doc_id", "text")
    return text.long_clean_texts(documents, "text", longer_than=50)


@query("f13_clean_texts", sql=f"""
    SELECT conv_id, turn, {joined_sql(clean_words_sql('text'))} AS text FROM conversations""")
def clean_texts(spark, sf_dir):
    turns = dealt(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return turns.withColumn("text", text.clean_text(F.col("text")))


def _clean_column_sql(column: str) -> str:
    low = f"nullif(lower(trim({column})), 'economy')"
    bare = f"translate({low}, {quoted('-' + text.PUNCTUATION.replace('-', ''))}, ' ')"
    return joined_sql(f"list_filter({words_sql(bare)}, lambda x: x NOT IN ({STOP_SQL}))") + f" AS {column}"


@query("f14_clean_string_columns", sql=f"""
    SELECT p_partkey, {_clean_column_sql('p_name')}, {_clean_column_sql('p_brand')}, {_clean_column_sql('p_type')} FROM part""")
def clean_string_columns(spark, sf_dir):
    df = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    return text.clean_string_columns(df, missing="economy")


@query("f15_conditional", sql="""
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 5000 THEN 'low' ELSE 'high' END AS level FROM customer""")
def conditional(spark, sf_dir):
    balance = F.col("c_acctbal")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(balance < 0, "debt").when(balance < 5000, "low").otherwise("high").alias("level"))


@query("f16_log_abs_square", sql="""
    SELECT event_id, round(log2(value), 6) AS bits, round(ln(value), 6) AS nats,
           round(abs(value - 50), 6) AS distance, round(pow(value - 50, 2), 4) AS squared FROM events""")
def log_abs_square(spark, sf_dir):
    v = F.col("value")
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(F.log2(v), 6).alias("bits"), F.round(F.ln(v), 6).alias("nats"),
        F.round(F.abs(v - 50), 6).alias("distance"), F.round(F.pow(v - 50, 2), 4).alias("squared"))


@query("f17_normal_density", sql="""
    SELECT event_id, round(exp(-pow((value - 50) / 40, 2) / 2) / (40 * sqrt(2 * pi())), 9) AS density FROM events""")
def normal_density(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(numeric.normal_density(F.col("value"), F.lit(50), F.lit(40)), 9).alias("density"))


@query("f18_distances", sql="""
    SELECT vec_id, round(sqrt(list_sum(list_transform(list_zip(e, c), lambda p: pow(p[1] - p[2], 2)))), 5) AS euclidean,
           round(list_sum(list_transform(list_zip(e, c), lambda p: abs(p[1] - p[2]))), 5) AS manhattan
    FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, CAST(list_reverse(embedding) AS DOUBLE[]) AS c FROM embeddings)""")
def distances(spark, sf_dir):
    """Distance of each vector from its own reversal."""
    e = F.col("embedding").cast("array<double>")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(numeric.euclidean(e, F.reverse(e)), 5).alias("euclidean"),
        F.round(numeric.manhattan(e, F.reverse(e)), 5).alias("manhattan"))


@query("f19_time_bucket", sql="""
    SELECT event_id, time_bucket(INTERVAL 1 HOUR, ts) AS bucket_start,
           time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS bucket_end FROM events""")
def time_bucket(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.window("ts", "60 minutes").alias("w")).select(
        "event_id", F.col("w.start").alias("bucket_start"), F.col("w.end").alias("bucket_end"))
