"""Literal results: small inputs whose answers are known beforehand."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from brightloom.functions import names, numeric, text
from brightloom.operators import aggregates, columns as cols, evaluate, graph, joins, ranking
from brightloom.operators.primes import with_prime_key
from brightloom.plans.column_operations import rule_conditions
from brightloom.sources import readers

# The ten training and ten test rows of the rule (index, refund, status, income, cheat).
TRAIN = """
1 yes single yes no
2 no married yes no
3 no single no no
4 yes married yes no
5 no divorced yes yes
6 no married no no
7 yes divorced yes no
8 no single yes yes
9 no married no no
10 no single yes yes
"""


@pytest.fixture(scope="module")
def train(spark):
    lines = readers.block_to_lines(spark, TRAIN)
    return readers.split_lines(lines, ["refund", "marital_status", "income_above_80k", "cheat"], " ", index_first=True)


def test_page_rank_of_the_demo_graph(spark):
    lines = spark.createDataFrame([("a b c",), ("b a a",), ("c b",), ("d a",)], "value string")
    ranks = {r["id"]: r["rank"] for r in graph.page_rank(graph.out_links(lines), 10).collect()}
    assert ranks == pytest.approx({"a": 0.3984375, "b": 0.3984375, "c": 0.203125})


def test_entropy_and_gains(train):
    entropy = aggregates.entropy(train, "cheat").first()["entropy"]
    assert entropy == pytest.approx(0.88129, abs=1e-5)
    gains = {r["attribute"]: r["gain"] for r in aggregates.information_gain(
        train, ["refund", "marital_status", "income_above_80k"], "cheat").collect()}
    assert gains == pytest.approx({"marital_status": 0.28129, "refund": 0.19163, "income_above_80k": 0.19163}, abs=1e-5)


def test_rule_in_both_forms(train):
    both = train.select(
        cols.rule_nested(rule_conditions()).alias("nested"),
        cols.rule_flat(rule_conditions()).alias("flat"),
        (F.col("cheat") == "yes").cast("int").alias("y"))
    rows = both.collect()
    assert all(r["nested"] == r["flat"] for r in rows)
    assert evaluate.accuracy(both, "y", "nested").first()["accuracy"] == 1.0
    assert evaluate.binary_counts(both, "y", "nested").first().asDict() == {"tp": 3, "fp": 0, "fn": 0, "tn": 7}


def test_one_attribute_rule(train):
    rows = train.select(
        cols.rule_nested(rule_conditions()[2:]).alias("p"), (F.col("cheat") == "yes").cast("int").alias("y"))
    assert evaluate.accuracy(rows, "y", "p").first()["accuracy"] == pytest.approx(0.7)
    assert evaluate.binary_counts(rows, "y", "p").first().asDict() == {"tp": 3, "fp": 3, "fn": 0, "tn": 4}


def test_dice_duel(spark):
    def side(values):
        return spark.createDataFrame([(v,) for v in values], "v int")

    a, b = side([9, 9, 9, 9, 2, 2]), side([3, 3, 3, 3, 11, 11])
    assert joins.share_at_least(a, b, "v").first()["share"] == pytest.approx(4 / 9)


def test_primes_by_sieve_and_by_predicate(spark):
    numbers = readers.number_range(spark, 100, 10_001, 3)
    by_sieve = with_prime_key(numbers, "id", ["id"])
    by_predicate = numbers.filter(numeric.array_predicate(numeric.prime_mask)("id"))
    assert by_sieve.count() == 1204
    assert by_sieve.exceptAll(by_predicate).isEmpty() and by_predicate.count() == 1204


def test_small_primes(spark):
    found = [r["id"] for r in with_prime_key(spark.range(-3, 40), "id", ["id"]).orderBy("id").collect()]
    assert found == [2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37]


def test_primes_among_large_far_and_repeated_keys(spark):
    large = [10**12 + i for i in range(200)] + [999_983 ** 2, 2**61 - 1 - 2**60, 1_000_003, 4, None] + [7] * 300
    df = spark.createDataFrame([(k, i) for i, k in enumerate(large)], "k long, n int")

    def plain(k):
        return k is not None and k > 1 and all(k % d for d in range(2, min(int(k**0.5) + 1, 2_000_000)))

    keys = [k for k in large if k is None or k < 1 << 50]
    got = sorted(r["k"] for r in with_prime_key(df.filter("k IS NULL OR k < 1125899906842624"), "k", ["n"]).collect())
    assert got == sorted(k for k in keys if plain(k))


def test_descriptive_statistics(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "x double")
    row = aggregates.describe(df, ["x"]).first()
    assert (row["mean"], row["median"]) == (4.25, 3.0)
    assert row["std"] == pytest.approx(4.0311, abs=1e-4)
    assert row["skew"] == pytest.approx(1.4693, abs=1e-4)


def test_ordered_split_sizes(spark):
    tagged = ranking.ordered_split(spark.range(10_129), ["id"], 0.2)
    counts = {r["split"]: r["count"] for r in tagged.groupBy("split").count().collect()}
    assert counts == {"test": 2025, "train": 8104}
    assert tagged.filter("split = 'test'").agg(F.max("id")).first()[0] == 2024


def test_hops_follow_direction_and_skip_the_unreachable(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1), (5, 6)], "src long, dst long")
    landmarks = spark.createDataFrame([(1,)], "id long")
    hops = {r["id"]: r["hops"] for r in graph.shortest_hops(edges, landmarks).collect()}
    assert hops == {1: 0, 3: 1, 4: 1, 2: 2}
    maps = {r["id"]: r["distances"] for r in graph.hop_map(graph.shortest_hops(edges, landmarks)).collect()}
    assert maps[2] == {"1": 2} and 5 not in maps


def test_motifs(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c"), ("c", "d")], "src string, dst string")
    assert {tuple(r) for r in graph.without_reverse(edges).collect()} == {("b", "c"), ("c", "d")}
    paths = {"".join(r) for r in graph.three_hop_paths(edges).collect()}
    assert paths == {"abab", "baba", "abcd", "babc"}


def test_names():
    assert [names.camel_to_snake(n) for n in ("airportID", "sourceAirport", "city")] == ["airport_id", "source_airport", "city"]
    assert names.split_capitals("LowTemp") == "low_temp" and names.split_capitals("airportID") == "airport_i_d"
    assert names.plain(" Ice Cream ") == "ice_cream"


def test_age_classes_leave_gaps(spark):
    ages = [39, 40, 41, 49, 50, 55, 60, 69, 70, 71]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    got = [r[0] for r in df.select(numeric.bin_by_bounds(F.col("age"))).collect()]
    assert got == ["below_40", "below_40", "40_49", "40_49", "below_40", "50_59", "below_40", "60_69", "below_40", "70_above"]


def test_class_rounding_edges(spark):
    df = spark.createDataFrame([(x,) for x in (-1.0, 0.49, 0.5, 1.49, 1.5, 2.49, 2.5, 9.0)], "x double")
    assert [r[0] for r in df.select(numeric.round_to_class(F.col("x"))).collect()] == [0, 0, 1, 1, 2, 2, 3, 3]


def test_text_cleaning_keeps_repeats_and_counts_strictly(spark):
    long_text = " ".join(["Cat's"] * 51)
    df = spark.createDataFrame([("The cat, the CAT and a dog-house 42!",), (long_text,)], "t string")
    got = [r[0] for r in df.select(text.clean_text(F.col("t"))).collect()]
    assert got[0] == "cat cat doghouse" and got[1] == " ".join(["cats"] * 51)
    kept = [r[0] for r in df.select(text.clean_text(F.col("t"), longer_than=50)).collect()]
    assert kept[0] is None and kept[1] is not None
    assert df.select(text.clean_text(F.col("t"), longer_than=51)).collect()[1][0] is None


def test_dash_becomes_space_and_bracket_goes(spark):
    df = spark.createDataFrame([("a-b (c)",)], "t string")
    assert df.select(text.dash_to_space(F.col("t"))).first()[0] == "a b c"


def test_clean_string_columns(spark):
    df = spark.createDataFrame([(1, " Not in universe "), (2, "Self-employed, of the State")], "id int, c string")
    assert [r["c"] for r in text.clean_string_columns(df).orderBy("id").collect()] == [None, "self employed state"]


def test_area_under_roc_with_ties(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.4), (0, 0.4), (0, 0.1)], "y int, s double")
    assert evaluate.area_under_roc(df, "y", "s").first()["auc"] == pytest.approx(3.5 / 4)


def test_mutual_information_of_equal_columns(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "y")] * 4, "f string, t string")
    assert aggregates.mutual_information(df, ["f"], "t").first()["mutual_information"] == pytest.approx(math.log(2))


def test_histogram_puts_the_top_value_in_the_last_bin(spark):
    bins = {r["bin"]: r["n"] for r in aggregates.histogram(spark.range(11), "id", 5).collect()}
    assert bins == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_sql_and_columns_agree(spark, sf_dir):
    from brightloom.sources.writers import run_sql

    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    by_sql = run_sql(
        customers, "SELECT c_nationkey, avg(c_acctbal) AS a FROM people GROUP BY c_nationkey ORDER BY a DESC, c_nationkey", "people")
    by_columns = aggregates.group_average(customers, ["c_nationkey"], "c_acctbal", "a")
    assert by_sql.collect() == by_columns.collect()
