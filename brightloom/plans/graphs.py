"""Graph jobs.

Three graphs are built from whole tables: the chain line to order to customer to
nation to region (vertex number = key * 10 + kind), supplier pairs met through
parts, and the two-way supplier and part graph.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from brightloom.operators import aggregates, graph
from brightloom.plans.registry import query, table
from brightloom.session import partitions_for

REGION, NATION, CUSTOMER, ORDER, LINE = 0, 1, 2, 3, 4


def chain_edges(spark, sf_dir):
    """Each row of a table points at the row it refers to."""
    def edge(src_kind, src, dst_kind, dst):
        return graph.with_key(src_kind, src).alias("src"), graph.with_key(dst_kind, dst).alias("dst")

    c = F.col
    line = c("l_orderkey") * 10 + c("l_linenumber")
    parts = [
        table(spark, sf_dir, "nation").select(*edge(NATION, c("n_nationkey"), REGION, c("n_regionkey"))),
        table(spark, sf_dir, "customer").select(*edge(CUSTOMER, c("c_custkey"), NATION, c("c_nationkey"))),
        table(spark, sf_dir, "orders").select(*edge(ORDER, c("o_orderkey"), CUSTOMER, c("o_custkey"))),
        # Only lines can repeat: their key is not unique.
        table(spark, sf_dir, "lineitem").select(*edge(LINE, line, ORDER, c("l_orderkey"))).distinct(),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


CHAIN_SQL = """(
    SELECT CAST(n_nationkey AS BIGINT) * 10 + 1 AS src, CAST(n_regionkey AS BIGINT) * 10 AS dst FROM nation
    UNION ALL SELECT c_custkey * 10 + 2, CAST(c_nationkey AS BIGINT) * 10 + 1 FROM customer
    UNION ALL SELECT o_orderkey * 10 + 3, o_custkey * 10 + 2 FROM orders
    UNION ALL SELECT DISTINCT (l_orderkey * 10 + l_linenumber) * 10 + 4, l_orderkey * 10 + 3 FROM lineitem)"""


def supplier_edges(spark, sf_dir):
    """Distinct pairs of a line's supplier and the supplier that its part's number falls to."""
    n = table(spark, sf_dir, "supplier").count()
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("src"), (F.col("l_partkey") % n).alias("dst")).distinct()


PAIR_SQL = "(SELECT DISTINCT l_suppkey AS src, l_partkey % (SELECT count(*) FROM supplier) AS dst FROM lineitem)"


def supply_edges(spark, sf_dir):
    """Suppliers (kind 5) and parts (kind 6) that met in a line, in both directions."""
    pairs = table(spark, sf_dir, "lineitem").select(
        graph.with_key(5, F.col("l_suppkey")).alias("src"), graph.with_key(6, F.col("l_partkey")).alias("dst")).distinct()
    return pairs.union(pairs.select("dst", "src"))


SUPPLY_SQL = """
    pairs AS (SELECT DISTINCT l_suppkey * 10 + 5 AS src, l_partkey * 10 + 6 AS dst FROM lineitem),
    edges AS (SELECT src, dst FROM pairs UNION ALL SELECT dst, src FROM pairs)"""


@query("g01_known_edges", sql="""
    SELECT DISTINCT o_custkey AS src, l_suppkey AS dst FROM orders JOIN lineitem ON o_orderkey = l_orderkey
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
      AND l_suppkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def known_edges(spark, sf_dir):
    """Customer to supplier numbers, both of them among customers in credit."""
    edges = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey")
    ).select(F.col("o_custkey").alias("src"), F.col("l_suppkey").alias("dst"))
    known = table(spark, sf_dir, "customer").filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("id"))
    return graph.known_edges(edges, known)


@query("g02_graph_counts", sql=f"""
    SELECT (SELECT count(*) FROM (SELECT src FROM {CHAIN_SQL} UNION SELECT dst FROM {CHAIN_SQL})) AS n_vertices,
           (SELECT count(*) FROM {CHAIN_SQL}) AS n_edges""")
def graph_counts(spark, sf_dir):
    edges = chain_edges(spark, sf_dir)
    return graph.vertices(edges).agg(F.count("*").alias("n_vertices")).select(
        "n_vertices", edges.agg(F.count("*")).scalar().alias("n_edges"))


@query("g03_edges_around", sql=f"SELECT src, dst FROM {CHAIN_SQL} WHERE src = 71 OR dst = 71")
def edges_around(spark, sf_dir):
    """The subgraph around nation 7."""
    return graph.edges_around(chain_edges(spark, sf_dir), 7 * 10 + NATION)


@query("g04_connected_vertices", sql="""
    SELECT c_custkey AS id, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def connected_vertices(spark, sf_dir):
    """Customers without an order are isolated."""
    orders = table(spark, sf_dir, "orders")
    edges = orders.select(F.col("o_custkey").alias("src"), F.col("o_custkey").alias("dst"))
    return graph.connected(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name"), edges)


@query("g05_motif_counts", sql=f"""
    SELECT 'no reverse' AS motif, count(*) AS n FROM {PAIR_SQL} e
    WHERE NOT EXISTS (SELECT 1 FROM {PAIR_SQL} r WHERE r.src = e.dst AND r.dst = e.src)
    UNION ALL SELECT 'three hops', count(*) FROM {CHAIN_SQL} ab JOIN {CHAIN_SQL} bc ON ab.dst = bc.src
    JOIN {CHAIN_SQL} cd ON bc.dst = cd.src""")
def motif_counts(spark, sf_dir):
    """Counted by degrees; no path is built."""
    lonely = graph.without_reverse(supplier_edges(spark, sf_dir))
    paths = graph.three_hop_count(chain_edges(spark, sf_dir))
    return lonely.agg(F.lit("no reverse").alias("motif"), F.count("*").alias("n")).union(
        paths.select(F.lit("three hops").alias("motif"), "n"))


HOPS_SQL = f"""
    WITH RECURSIVE edges AS MATERIALIZED (SELECT src, dst FROM {CHAIN_SQL}),
    walk(id, landmark, hops) AS (
        SELECT CAST(r_regionkey AS BIGINT) * 10, CAST(r_regionkey AS BIGINT) * 10, CAST(0 AS BIGINT) FROM region
        UNION SELECT e.src, w.landmark, w.hops + 1 FROM edges e JOIN walk w ON e.dst = w.id),
    hops AS (SELECT id, landmark, min(hops) AS hops FROM walk GROUP BY id, landmark)"""


def region_hops(spark, sf_dir):
    landmarks = table(spark, sf_dir, "region").select(graph.with_key(REGION, F.col("r_regionkey")).alias("id"))
    return graph.shortest_hops(chain_edges(spark, sf_dir), landmarks)


@query("g06_shortest_hops", sql=HOPS_SQL + " SELECT id, landmark, hops FROM hops")
def shortest_hops(spark, sf_dir):
    return region_hops(spark, sf_dir).select("id", "landmark", "hops")


@query("g07_four_hops_away", sql=HOPS_SQL + " SELECT id FROM hops WHERE landmark = 20 AND hops = 4")
def four_hops_away(spark, sf_dir):
    """Vertices exactly four hops from region 2, read from the distance map of that one landmark."""
    region = table(spark, sf_dir, "region").filter("r_regionkey = 2").select(graph.with_key(REGION, F.col("r_regionkey")).alias("id"))
    distances = graph.hop_map(graph.shortest_hops(chain_edges(spark, sf_dir), region, max_rounds=4))
    return distances.filter(F.try_element_at("distances", F.lit(str(2 * 10 + REGION))) == 4).select("id")


@query("g08_page_rank", sql=f"""
    WITH RECURSIVE {SUPPLY_SQL},
    links AS MATERIALIZED (SELECT src, dst, count(*) OVER (PARTITION BY src) AS n FROM edges),
    ranks(round, id, rank) AS (
        SELECT 0, src, 1.0::DOUBLE / (SELECT count(DISTINCT src) FROM edges) FROM (SELECT DISTINCT src FROM edges)
        UNION ALL
        SELECT any_value(r.round) + 1, l.dst, sum(r.rank / l.n) FROM ranks r JOIN links l ON l.src = r.id
        WHERE r.round < 10 GROUP BY l.dst)
    SELECT id, round(rank, 9) AS rank FROM ranks WHERE round = 10""")
def page_rank(spark, sf_dir):
    with partitions_for(spark, 2 * table(spark, sf_dir, "lineitem").count()):
        ranks = graph.page_rank(supply_edges(spark, sf_dir), 10)
    return ranks.select("id", F.round("rank", 9).alias("rank"))


# Link targets of one page, in the order they stand in its text.
HREF = 'href="([^"]*)"'


def page_links(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(HREF), 1)).alias("dst"))


@query("g09_back_links", sql=f"""
    WITH links AS (SELECT DISTINCT url AS src, unnest(regexp_extract_all(html, '{HREF}', 1)) AS dst FROM pages)
    SELECT dst, CAST(floor(pos / 1000) AS BIGINT) AS block, string_agg(src, ' ' ORDER BY src) AS sources
    FROM (SELECT src, dst, row_number() OVER (PARTITION BY dst ORDER BY src) - 1 AS pos FROM links) GROUP BY dst, block""")
def back_links(spark, sf_dir):
    """Pages that link to each target."""
    return aggregates.posting_blocks(page_links(spark, sf_dir), "dst", "src").select(
        "dst", "block", F.array_join("values", " ").alias("sources"))


@query("g10_out_links", sql=f"""
    SELECT url AS src, array_to_string(list_sort(list_distinct(regexp_extract_all(html, '{HREF}', 1))), ' ') AS targets
    FROM pages WHERE len(regexp_extract_all(html, '{HREF}', 1)) > 0""")
def out_links(spark, sf_dir):
    """Distinct sorted targets of each page; a page is one row, so its list stays inside the row."""
    links = F.array_sort(F.array_distinct(F.regexp_extract_all("html", F.lit(HREF), 1)))
    return table(spark, sf_dir, "pages").select(
        F.col("url").alias("src"), F.array_join(links, " ").alias("targets")).filter(F.col("targets") != "")
