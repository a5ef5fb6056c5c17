"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightloom.llm.common import written


def _flattened(parents: DataFrame) -> DataFrame:
    """Follow ``node -> parent`` to the end; each step doubles the way that is covered."""
    while True:
        ahead = parents.select(F.col("node").alias("parent"), F.col("parent").alias("_next"))
        moved = written(parents.join(ahead, "parent", "left").select(
            "node", F.coalesce("_next", "parent").alias("parent"), F.col("_next").isNotNull().alias("_moved")), "parents")
        parents = moved.select("node", "parent")
        if moved.filter("_moved").isEmpty():
            return parents


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``) that is not the smallest of its component.

    Every node hangs on its smallest smaller neighbour, trees are flattened, and links between trees
    are carried on to the next round. A hub costs one row in each task before its minimum is taken.
    Nulls and links of a node to itself are left out. Nothing is collected.
    """
    kind = dict(links.dtypes)["a"]
    edges = links.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = written(edges.distinct(), "links")
    roots = links.sparkSession.createDataFrame([], f"node {kind}, root {kind}")
    while not edges.isEmpty():
        parents = _flattened(written(edges.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("parent")), "parents"))
        ahead = parents.select(F.col("node").alias("root"), F.col("parent").alias("_root"))
        carried = roots.join(ahead, "root", "left").select("node", F.coalesce("_root", "root").alias("root"))
        roots = written(carried.unionByName(parents.select("node", F.col("parent").alias("root"))), "roots")
        to = parents.withColumnsRenamed({"node": "_n", "parent": "_p"})
        for end in ("a", "b"):
            edges = edges.join(to, F.col(end) == F.col("_n"), "left").withColumn(end, F.coalesce("_p", end)).drop("_n", "_p")
        edges = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    return roots
