"""Projection, filter, column and schema operations."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from brightloom.functions import names, numeric
from brightloom.operators import columns as cols, primes
from brightloom.operators.positions import with_position
from brightloom.plans.registry import query, table
from brightloom.session import scratch_path
from brightloom.sources import readers, writers

# The number inside events.props, whose text is {"k": N}.
K_SQL = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"


def events_k():
    return F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")


@query("c01_select", sql="SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def select(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")


@query("c02_alias", sql="SELECT p_partkey AS id, p_retailprice * 2 AS double_price FROM part")
def alias(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"), (F.col("p_retailprice") * 2).alias("double_price"))


@query("c03_rename_all", sql="""
    SELECT s_suppkey AS supplier_id, s_name AS supplier_name, s_nationkey AS nation, s_acctbal AS balance FROM supplier""")
def rename_all(spark, sf_dir):
    return names.rename_all(table(spark, sf_dir, "supplier"), "supplierID, supplierName, nation, balance")


@query("c04_normalise_names", sql="""
    SELECT c_custkey AS customer_key, c_name AS customer_name, c_nationkey AS nation_key,
           c_acctbal AS account_balance, c_mktsegment AS market_segment FROM customer""")
def normalise_names(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    spaced = df.toDF(" Customer Key", "customer name ", "nationKey", "accountBalance", "marketSegment")
    return names.normalise_names(spaced, lambda c: names.plain(c) if " " in c else names.camel_to_snake(c))


@query("c05_add_replace_drop", sql="""
    SELECT o_orderkey, o_totalprice / 1000 AS o_totalprice, year(o_orderdate)::INT AS order_year FROM orders""")
def add_replace_drop(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .withColumn("order_year", F.year("o_orderdate"))
        .withColumn("o_totalprice", F.col("o_totalprice") / 1000)
        .drop("o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    )


@query("c06_sentinels_to_null", sql="""
    SELECT o_orderkey, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority FROM orders""")
def sentinels_to_null(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return cols.sentinels_to_null(df, sentinels=[*cols.SENTINELS, "4-NOT SPECIFIED"])


@query("c07_constant_column", sql="SELECT doc_id, lang, 'document' AS kind FROM documents")
def constant_column(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "lang", F.lit("document").alias("kind"))


@query("c08_equality_filter", sql="""
    SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'""")
def equality_filter(spark, sf_dir):
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .filter(F.col("o_orderpriority") != "5-LOW")
        .select("o_orderkey", "o_orderpriority")
    )


@query("c09_compound_filter", sql="""
    SELECT p_partkey, p_type, p_size FROM part
    WHERE (p_type = 'PROMO' AND p_size > 40) OR NOT (p_type <> 'SMALL' OR p_size >= 10)""")
def compound_filter(spark, sf_dir):
    kind, size = F.col("p_type"), F.col("p_size")
    return (
        table(spark, sf_dir, "part")
        .filter(((kind == "PROMO") & (size > 40)) | ~((kind != "SMALL") | (size >= 10)))
        .select("p_partkey", "p_type", "p_size")
    )


@query("c10_not_null_filter", sql="""
    SELECT o_orderkey FROM orders WHERE nullif(o_orderpriority, '4-NOT SPECIFIED') IS NOT NULL""")
def not_null_filter(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    df = cols.sentinels_to_null(df, sentinels=["4-NOT SPECIFIED"])
    return df.filter(F.col("o_orderpriority").isNotNull()).select("o_orderkey")


@query("c11_substring_filter", sql="SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def substring_filter(spark, sf_dir):
    return table(spark, sf_dir, "part").filter(F.col("p_name").contains("ring")).select("p_partkey", "p_name")


@query("c12_sql_predicate", sql="""
    SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_returnflag = 'R' OR l_discount = 0.1""")
def sql_predicate(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").filter("l_returnflag = 'R' or l_discount = 0.1D").select(
        "l_orderkey", "l_linenumber", "l_discount")


@query("c13_drop_incomplete_rows", sql="""
    SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
    WHERE o_orderpriority <> '4-NOT SPECIFIED' AND o_orderstatus <> 'P'""")
def drop_incomplete(spark, sf_dir):
    df = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return cols.sentinels_to_null(df, sentinels=["4-NOT SPECIFIED", "P"]).dropna("any")


@query("c14_header_line_removal", sql="""
    SELECT CAST(s_suppkey AS VARCHAR) || ',' || s_name AS value FROM supplier""")
def header_removal(spark, sf_dir):
    """Every part file carries the header line."""
    path = scratch_path(spark, "with-header")
    writers.write_csv(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name").repartition(4), path)
    return readers.drop_header_lines(readers.read_lines(spark, path), "s_suppkey,s_name")


PRIME_SQL = """
    SELECT {key} FROM {table} WHERE {key} >= 2 AND NOT EXISTS (
        SELECT 1 FROM (SELECT unnest(range(2, (SELECT CAST(sqrt(max({key})) AS BIGINT) + 2 FROM {table}))) AS d)
        WHERE d * d <= {key} AND {key} % d = 0)"""


@query("c15_python_predicate", sql=PRIME_SQL.format(key="p_partkey", table="part"))
def python_predicate(spark, sf_dir):
    """A test on whole arrays, written in Python."""
    return table(spark, sf_dir, "part").select("p_partkey").filter(numeric.array_predicate(numeric.prime_mask)("p_partkey"))


@query("c16_prime_keys", sql=PRIME_SQL.format(key="o_orderkey", table="orders"))
def prime_keys(spark, sf_dir):
    return primes.with_prime_key(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", ["o_orderkey"])


@query("c17_celsius", sql="SELECT event_id, round((value - 32) * 5 / 9, 6) AS celsius FROM events")
def celsius(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", F.round(numeric.fahrenheit_to_celsius(F.col("value")), 6).alias("celsius"))


@query("c18_cast", sql=f"""
    SELECT event_id, {K_SQL} AS k, CAST(value > 100 AS INTEGER) AS is_high,
           TRY_CAST(event_type AS INTEGER) AS bad_number FROM events""")
def cast(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        events_k().alias("k"),
        (F.col("value") > 100).cast("int").alias("is_high"),
        F.col("event_type").try_cast("int").alias("bad_number"),
    )


@query("c19_surrogate_key", sql="""
    SELECT row_number() OVER (ORDER BY p_name, p_partkey) AS key, p_partkey, p_name FROM part""")
def surrogate_key(spark, sf_dir):
    return with_position(table(spark, sf_dir, "part").select("p_partkey", "p_name"), ["p_name", "p_partkey"], "key", 1)


@query("c20_recode", sql="""
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS done FROM orders""")
def recode(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", numeric.recode(F.col("o_orderstatus"), {"F": 1, "O": 0}).alias("done"))


def returns(spark, sf_dir):
    """Order lines as rows of the rule's three attributes: flag, status and price level."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_returnflag") == "R", "yes").otherwise("no").alias("refund"),
        F.when(F.col("l_returnflag") == "N", "single").when(F.col("l_linestatus") == "O", "married")
        .otherwise("divorced").alias("marital_status"),
        F.when(F.col("l_extendedprice") > 80000, "yes").otherwise("no").alias("income_above_80k"),
        F.when(F.col("l_discount") > 0.05, "yes").otherwise("no").alias("cheat"),
    )


RETURNS_SQL = """(
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN 'yes' ELSE 'no' END AS refund,
           CASE WHEN l_returnflag = 'N' THEN 'single' WHEN l_linestatus = 'O' THEN 'married' ELSE 'divorced' END AS marital_status,
           CASE WHEN l_extendedprice > 80000 THEN 'yes' ELSE 'no' END AS income_above_80k,
           CASE WHEN l_discount > 0.05 THEN 'yes' ELSE 'no' END AS cheat FROM lineitem)"""

RULE_SQL = "CAST(refund = 'no' AND income_above_80k = 'yes' AND marital_status <> 'married' AS INTEGER)"


def rule_conditions():
    """No refund, a high income, and not married."""
    return [F.col("refund") == "no", F.col("income_above_80k") == "yes", F.col("marital_status") != "married"]


@query("c21_rule_nested", sql=f"SELECT l_orderkey, l_linenumber, {RULE_SQL} AS predicted FROM {RETURNS_SQL}")
def rule_nested(spark, sf_dir):
    return returns(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        cols.rule_nested(rule_conditions()).alias("predicted"))


@query("c22_rule_on_codes", sql=f"SELECT l_orderkey, l_linenumber, {RULE_SQL} AS predicted FROM {RETURNS_SQL}")
def rule_on_codes(spark, sf_dir):
    yes_no = {"no": 0, "yes": 1}
    return returns(spark, sf_dir).select(
        "l_orderkey", "l_linenumber",
        cols.rule_flat([
            numeric.recode(F.col("refund"), yes_no) == 0,
            numeric.recode(F.col("income_above_80k"), yes_no) == 1,
            numeric.recode(F.col("marital_status"), {"divorced": 0, "married": 1, "single": 2}) != 1,
        ]).alias("predicted"))


@query("c23_rule_one_attribute", sql=f"""
    SELECT l_orderkey, l_linenumber, CASE WHEN marital_status <> 'married' THEN 1 ELSE 0 END AS predicted FROM {RETURNS_SQL}""")
def rule_one_attribute(spark, sf_dir):
    return returns(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", cols.rule_nested(rule_conditions()[2:]).alias("predicted"))


@query("c24_age_classes", sql=f"""
    SELECT event_id, CASE WHEN k > 40 AND k <= 49 THEN '40_49' WHEN k > 50 AND k <= 59 THEN '50_59'
                          WHEN k > 60 AND k <= 69 THEN '60_69' WHEN k > 70 THEN '70_above' ELSE 'below_40' END AS age_class
    FROM (SELECT event_id, {K_SQL} AS k FROM events)""")
def age_classes(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", numeric.bin_by_bounds(events_k()).alias("age_class"))


@query("c25_round_to_class", sql="""
    SELECT event_id, CAST(CASE WHEN x < 0.5 THEN 0 WHEN x < 1.5 THEN 1 WHEN x < 2.5 THEN 2 ELSE 3 END AS BIGINT) AS class
    FROM (SELECT event_id, value / 50 AS x FROM events)""")
def round_to_class(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", numeric.round_to_class(F.col("value") / 50).alias("class"))


@query("c26_map_and_struct_access", sql=f"""
    SELECT event_id, time_bucket(INTERVAL 1 HOUR, ts) AS hour_start,
           CASE event_type WHEN 'click' THEN value END AS click_value, {K_SQL} AS k FROM events""")
def map_and_struct(spark, sf_dir):
    df = table(spark, sf_dir, "events").select(
        "event_id",
        F.window("ts", "1 hour").alias("window"),
        F.create_map(F.col("event_type"), F.col("value")).alias("values"),
        F.struct(events_k().alias("k")).alias("props"),
    )
    return df.select(
        "event_id", F.col("window.start").alias("hour_start"),
        F.try_element_at("values", F.lit("click")).alias("click_value"), "props.k")


@query("c27_pair_reshape", sql="""
    SELECT l_partkey AS key, l_suppkey * 10 AS value FROM lineitem""")
def pair_reshape(spark, sf_dir):
    """Swap key and value of (supplier, part) pairs, then map the values."""
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("key"), F.col("l_partkey").alias("value"))
    swapped = pairs.select(F.col("value").alias("key"), F.col("key").alias("value"))
    return swapped.withColumn("value", F.col("value") * 10)


@query("c28_round", sql="SELECT event_id, round(value / 7, 3) AS value FROM events")
def round_column(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(F.col("value") / 7, 3).alias("value"))


@query("c29_select_by_type", sql="SELECT c_name, c_mktsegment FROM customer")
def select_by_type(spark, sf_dir):
    df = table(spark, sf_dir, "customer")
    return df.select(*cols.columns_of_type(df, T.StringType))
