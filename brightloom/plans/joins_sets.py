"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.operators import graph, joins, knn
from brightloom.plans.registry import query, table
from brightloom.plans.graphs import CHAIN_SQL, PAIR_SQL, chain_edges, supplier_edges


@query("j01_inner_join_pairs", sql="""
    SELECT o_custkey AS key, c_mktsegment AS left_value, o_totalprice AS right_value
    FROM customer JOIN orders ON c_custkey = o_custkey""")
def inner_join_pairs(spark, sf_dir):
    left = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("left_value"))
    right = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("key"), F.col("o_totalprice").alias("right_value"))
    return left.join(right, "key", "inner")


@query("j02_multi_way_join", sql="""
    SELECT DISTINCT c_custkey AS custkey, n_name AS nation, r_name AS region, o_orderpriority AS priority
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey""")
def multi_way_join(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"))
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("custkey"), F.col("c_nationkey").alias("nationkey"))
    nations = table(spark, sf_dir, "nation").toDF("nationkey", "nation", "regionkey")
    regions = table(spark, sf_dir, "region").toDF("regionkey", "region")
    return joins.join_on_shared(orders.distinct(), customers, nations, regions).select("custkey", "nation", "region", "priority")


@query("j03_membership_filter", sql="""
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def membership_filter(spark, sf_dir):
    building = table(spark, sf_dir, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return joins.members_of(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_custkey", building, "c_custkey")


@query("j04_side_by_side", sql="""
    SELECT CAST(coalesce(c.position, s.position) AS BIGINT) AS position, c_name, c_acctbal, s_name, s_acctbal
    FROM (SELECT c_name, c_acctbal, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) - 1 AS position FROM customer) c
    FULL JOIN (SELECT s_name, s_acctbal, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) - 1 AS position FROM supplier) s
    ON c.position = s.position""")
def side_by_side(spark, sf_dir):
    return joins.side_by_side(
        table(spark, sf_dir, "customer"), [F.desc("c_acctbal"), "c_custkey"],
        table(spark, sf_dir, "supplier"), [F.desc("s_acctbal"), "s_suppkey"],
    ).select("position", "c_name", "c_acctbal", "s_name", "s_acctbal")


@query("j05_edges_without_reverse", sql=f"""
    SELECT e.src, e.dst FROM {PAIR_SQL} e LEFT JOIN {PAIR_SQL} r ON e.src = r.dst AND e.dst = r.src WHERE r.src IS NULL""")
def edges_without_reverse(spark, sf_dir):
    return graph.without_reverse(supplier_edges(spark, sf_dir))


@query("j06_three_hop_paths", sql=f"""
    SELECT ab.src AS a, ab.dst AS b, bc.dst AS c, cd.dst AS d
    FROM {CHAIN_SQL} ab JOIN {CHAIN_SQL} bc ON ab.dst = bc.src JOIN {CHAIN_SQL} cd ON bc.dst = cd.src""")
def three_hop_paths(spark, sf_dir):
    return graph.three_hop_paths(chain_edges(spark, sf_dir))


EMBEDDED_SQL = "(SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings)"


def pairs_sql(distance: str = "list_distance(a.e, b.e)") -> str:
    """All ranked pairs of embeddings, the brute-force statement."""
    return f"""(SELECT a.vec_id AS query, b.vec_id AS train, {distance} AS distance, a.label AS actual, b.label AS label,
        row_number() OVER (PARTITION BY a.vec_id ORDER BY {distance}, b.vec_id) AS rank
        FROM {EMBEDDED_SQL} a JOIN {EMBEDDED_SQL} b ON a.vec_id <> b.vec_id)"""


def embedded(spark, sf_dir, *more: str):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("features"), *more)


def embedding_neighbours(spark, sf_dir, k: int, p: int = 2):
    rows = embedded(spark, sf_dir)
    return knn.nearest_neighbours(
        rows.withColumnRenamed("id", "query"), rows, k, "query", "id", p=p, exclude_self=True)


@query("j07_neighbour_distances", sql=f"""
    SELECT query, train, rank, round(distance, 6) AS distance FROM {pairs_sql()} WHERE rank <= 10""")
def neighbour_distances(spark, sf_dir):
    """Distances of every vector to its nearest others; farther pairs are ruled out, not built."""
    return embedding_neighbours(spark, sf_dir, 10).select(
        "query", F.col("train_id").alias("train"), "rank", F.round("distance", 6).alias("distance"))


@query("j08_share_of_winning_pairs", sql="""
    SELECT round(avg(CASE WHEN a.o_totalprice >= b.o_totalprice THEN 1.0 ELSE 0.0 END), 8) AS share
    FROM (SELECT o_totalprice FROM orders WHERE o_orderstatus = 'F') a,
         (SELECT o_totalprice FROM orders WHERE o_orderstatus = 'O') b""")
def share_of_winning_pairs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return joins.share_at_least(
        orders.filter(F.col("o_orderstatus") == "F"), orders.filter(F.col("o_orderstatus") == "O"), "o_totalprice",
    ).select(F.round("share", 8).alias("share"))


@query("u01_stack_tables", sql="""
    SELECT 'document' AS kind, doc_id AS id, text FROM documents
    UNION ALL SELECT 'benchmark', item_id, text FROM benchmark""")
def stack_tables(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    items = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), "text", F.lit("benchmark").alias("kind"))
    return documents.unionByName(items)


@query("u02_distinct_endpoints", sql=f"SELECT src AS id FROM {CHAIN_SQL} UNION SELECT dst FROM {CHAIN_SQL}")
def distinct_endpoints(spark, sf_dir):
    return graph.vertices(chain_edges(spark, sf_dir))
