"""Plans that must hold at any size: pruned scans, pushed filters, no pairing of all rows."""

from __future__ import annotations

import pytest

from __spark_entry__ import queries

QUERIES = queries()


def plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def test_partition_filter_reads_one_folder(spark, sf_dir):
    text = plan(QUERIES["s12_partitioned_parquet"](spark, sf_dir))
    assert "PartitionFilters: [isnotnull(c_mktsegment" in text and "c_mktsegment" not in text.split("ReadSchema:")[1].splitlines()[0]


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    text = plan(QUERIES["s13_parquet_read"](spark, sf_dir))
    assert "GreaterThanOrEqual(l_quantity,45.0)" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text


def test_window_counts_read_two_columns(spark, sf_dir):
    text = plan(QUERIES["t01_tumbling_window_count"](spark, sf_dir))
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text


def test_terms_are_counted_inside_the_row(spark, sf_dir):
    """Texts are cleaned by one written pass; neither counts nor weights shuffle pairs of text and term."""
    for name in ("m09_term_counts", "m10_tfidf"):
        text = plan(QUERIES[name](spark, sf_dir))
        assert "Exchange" not in text and text.count("+- Scan parquet") + text.count("* Scan parquet") <= 1 and "regexp" not in text


def test_exact_profile_counts_without_expand(spark, sf_dir):
    assert "Expand" not in plan(QUERIES["a18_table_profile"](spark, sf_dir))


def test_graph_loops_leave_the_edges_where_they_are(spark, sf_dir, monkeypatch):
    """With broadcasts off, joins on bucketed edges exchange the other side only."""
    from brightloom.operators import graph

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        edges = spark.range(2000).selectExpr("id % 50 as src", "(id * 7) % 101 as dst").distinct()
        links = graph.bucketed(graph.adjacency(edges), "links", "src")
        known = spark.range(101).selectExpr("id as src", "1.0D as rank").repartition(5)
        text = links.join(known, "src")._jdf.queryExecution().executedPlan().toString()
        assert text.count("Exchange") - text.count("ReusedExchange") == 2 and "Bucketed: true" in text  # repartition(5) and the one to match
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", [
    "a04_group_average", "a10_value_frequencies", "a20_class_priors", "a23_information_gain", "c16_prime_keys",
    "e05_class_report", "g01_known_edges", "g05_motif_counts", "j02_multi_way_join", "j03_membership_filter",
    "j05_edges_without_reverse", "j06_three_hop_paths", "j08_share_of_winning_pairs", "l09_categorical_bayes", "l11_multinomial_bayes",
    "l10_gaussian_bayes", "m10_tfidf", "w03_ordered_split", "a14_descriptive_statistics", "a06_sorted_list_per_key"])
def test_no_query_pairs_all_rows(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


@pytest.mark.parametrize("name", ["c21_rule_nested", "f11_date_time", "c25_round_to_class", "t02_sliding_window_count", "m05_standardise"])
def test_expressions_stay_out_of_python(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "Pandas" not in text
