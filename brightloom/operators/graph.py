"""Graph jobs over an edge table (src, dst) and a vertex table (id)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brightloom.operators.joins import members_of
from brightloom.operators.skew import key_hash, salted_join
from brightloom.session import partitions_for, scratch_path


def _written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: lineage ends here, and the size on storage
    tells the planner whether this side of the next join is small enough to broadcast."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, *keys: str) -> DataFrame:
    """Write as a table bucketed and sorted by ``keys`` and read it back: joins on all of them leave it where it is.

    There are as many buckets as shuffle partitions, so the other side of a join is dealt to match. The table's
    name is given back at once; its files stay in the shared folder.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", scratch_path(spark, name)).saveAsTable(table)
    out = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return out


def vertices(edges: DataFrame) -> DataFrame:
    """Distinct endpoints."""
    return edges.select(F.col("src").alias("id")).union(edges.select(F.col("dst").alias("id"))).distinct()


def known_edges(edges: DataFrame, known: DataFrame) -> DataFrame:
    """Distinct edges with both ends in ``known`` (id)."""
    return members_of(members_of(edges, "src", known, "id"), "dst", known, "id").distinct()


def edges_around(edges: DataFrame, vertex) -> DataFrame:
    """Edges that leave or reach a vertex."""
    return edges.filter((F.col("src") == vertex) | (F.col("dst") == vertex))


def connected(vertex_table: DataFrame, edges: DataFrame) -> DataFrame:
    """Vertices with at least one edge."""
    return members_of(vertex_table, "id", vertices(edges), "id")


def without_reverse(edges: DataFrame) -> DataFrame:
    """Edges a to b for which no edge b to a exists."""
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return edges.join(back, ["src", "dst"], "left_anti")


def three_hop_paths(edges: DataFrame) -> DataFrame:
    """All paths a, b, c, d along three edges; vertices may repeat."""
    ab = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    bc = edges.select(F.col("src").alias("b"), F.col("dst").alias("c"))
    cd = edges.select(F.col("src").alias("c"), F.col("dst").alias("d"))
    return ab.join(bc, "b").join(cd, "c").select("a", "b", "c", "d")


def three_hop_count(edges: DataFrame) -> DataFrame:
    """Number of paths along three edges, one row ``n``, without building a path.

    An edge is the middle of as many paths as edges reach its source times edges leave its target. What leaves
    the targets is summed by source first, so hubs meet their counts as sums. Repeated edges count repeatedly.
    """
    leaving = edges.groupBy(F.col("src").alias("dst")).agg(F.count("*").alias("_out"))
    reaching = edges.groupBy(F.col("dst").alias("src")).agg(F.count("*").alias("_in"))
    onward = salted_join(edges.select("src", "dst"), leaving, ["dst"], ["src"]).groupBy("src").agg(F.sum("_out").alias("_out"))
    return onward.join(reaching, "src").agg(F.coalesce(F.sum(F.col("_out") * F.col("_in")), F.lit(0).cast("bigint")).alias("n"))


def shortest_hops(edges: DataFrame, landmarks: DataFrame, max_rounds: int | None = None) -> DataFrame:
    """Fewest edges from each vertex to each landmark, along edge direction: (id, landmark, hops).

    Each round moves the frontier one edge back and drops what was reached before. Edges are dealt to
    buckets by their target once, and what was reached by vertex and landmark, so that after the first
    round only the frontier moves. A vertex that reaches no landmark has no row. ``landmarks`` has a column ``id``.
    """
    pairs = ["id", "landmark"]
    edges = bucketed(edges.select("src", "dst").distinct(), "edges", "dst")
    frontier = bucketed(
        landmarks.select("id", F.col("id").alias("landmark"), F.lit(0).cast("bigint").alias("hops")).distinct(), "hops", *pairs)
    levels, compact, hops = [frontier], [frontier], 0
    while max_rounds is None or hops < max_rounds:
        hops += 1
        step = edges.join(frontier.select(F.col("id").alias("dst"), "landmark"), "dst").select(F.col("src").alias("id"), "landmark").distinct()
        for known in compact:
            step = step.join(known.select(*pairs), pairs, "left_anti")
        frontier = bucketed(step.withColumn("hops", F.lit(hops).cast("bigint")), "hops", *pairs)
        if frontier.isEmpty():
            break
        levels.append(frontier)
        compact.append(frontier)
        if len(compact) > 8:
            compact = [bucketed(reduce(DataFrame.union, compact), "reached", *pairs)]
            levels = compact[:]
    return reduce(DataFrame.union, levels)


def hop_map(hops: DataFrame) -> DataFrame:
    """One row per vertex with a map landmark to hops, as many entries as there are landmarks."""
    entries = F.collect_list(F.struct(F.col("landmark").cast("string"), "hops"))
    return hops.groupBy("id").agg(F.map_from_entries(entries).alias("distances"))


def out_links(lines: DataFrame, column: str = "value", sep: str = " ") -> DataFrame:
    """Link lines ``page target target ...`` to distinct edges; lines of one page are merged."""
    tokens = F.split(column, sep)
    pairs = lines.select(
        F.get(tokens, F.lit(0)).alias("src"),
        F.explode(F.slice(tokens, F.lit(2), F.greatest(F.size(tokens) - 1, F.lit(0)))).alias("dst"))
    return pairs.filter(F.col("dst") != "").distinct()


def adjacency(edges: DataFrame, block: int = 1000, share: float = 0.001) -> DataFrame:
    """Targets per source of distinct edges in lists of about ``block`` entries: (src, out_degree, piece, targets).

    A source with very many targets becomes many rows, so no task gathers all of them; sources with
    ``share`` of all edges meet their degree in many tasks.
    """
    degree = _written(edges.groupBy("src").agg(F.count("*").alias("out_degree")), "degrees")
    total = degree.agg(F.sum("out_degree")).first()[0] or 0
    heavy = degree.filter(F.col("out_degree") >= max(share * total, 1)).select(key_hash(["src"]))  # 1 / share at most
    hot = [r[0] for r in heavy.collect()]
    piece = F.pmod(F.xxhash64("dst"), F.ceil(F.col("out_degree") / block)).cast("int")
    return (
        salted_join(edges, degree, ["src"], ["dst"], hot=hot)
        .groupBy("src", "out_degree", piece.alias("piece"))
        .agg(F.collect_list("dst").alias("targets"))
    )


def _parts(joined: DataFrame) -> DataFrame:
    return joined.select(F.explode("targets").alias("id"), (F.col("rank") / F.col("out_degree")).alias("part"))


def contributions(links: DataFrame, ranks: DataFrame) -> DataFrame:
    """Each page's rank in equal parts to its targets: (id, part). The lists of a hot page meet its rank in many tasks."""
    return _parts(salted_join(links, ranks.select(F.col("id").alias("src"), "rank"), ["src"], ["src", "piece"]))


def page_rank(edges: DataFrame, rounds: int, cut_every: int = 5, share: float = 0.001, per_task: int = 1 << 20) -> DataFrame:
    """Rank by repeated sharing along edges, without damping: (id, rank).

    All endpoints start with an equal share of 1. A page that nobody links to is gone after the first
    round; rank sent to a page without links of its own is not passed on. Links are dealt to buckets by
    their page once, as many as keep a task at about ``per_task`` links; each round moves the ranks only. Pages with
    ``share`` of all links, at most ``1 / share`` of them, are kept apart in plain files, and their ranks are broadcast.
    """
    spark = edges.sparkSession
    edges = _written(edges.select("src", "dst").distinct(), "edges")
    total = edges.count()
    with partitions_for(spark, total, per_task):
        links = _written(adjacency(edges, share=share), "links")
        pages = _written(vertices(edges), "pages")
        few = links.filter(F.col("out_degree") >= max(share * total, 1000)).select("src").distinct()
        heavy = [r["src"] for r in few.collect()]
        is_heavy = F.col("src").isin(heavy) if heavy else F.lit(False)
        most = bucketed(links.filter(~is_heavy), "links", "src")
        ranks = pages.select("id", F.lit(1.0 / max(pages.count(), 1)).alias("rank"))
        for i in range(1, rounds + 1):
            known = ranks.withColumnRenamed("id", "src")
            parts = _parts(most.join(known, "src"))
            if heavy:
                few = known.filter(F.col("src").isin(heavy))
                parts = parts.union(_parts(links.filter(is_heavy).join(F.broadcast(few), "src")))
            ranks = parts.groupBy("id").agg(F.sum("part").alias("rank"))
            if heavy or i % cut_every == 0 or i == rounds:
                ranks = _written(ranks, f"ranks-{i}")
    return ranks


def with_key(kind: int, key: Column) -> Column:
    """A vertex number from a key and a one-digit kind, for graphs over several tables."""
    return key.cast("bigint") * 10 + kind
