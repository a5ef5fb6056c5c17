"""Row numbers and running sums, with a key that holds a third of the rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from brightloom.operators import aggregates, ranking
from brightloom.operators.positions import with_group_position, with_position, with_running_sums


def skewed(spark, n=3000):
    """Key 0 holds a third of the rows."""
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("key"),
        ((F.col("id") * 7919) % 1000).alias("v"))


def test_position_counts_every_row_once(spark):
    rows = with_position(skewed(spark), [F.desc("v"), "id"], "pos", 1).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(1, 3001))
    assert [(-r["v"], r["id"]) for r in rows] == sorted((-r["v"], r["id"]) for r in rows)


def test_group_position_of_hot_and_null_keys(spark):
    df = skewed(spark).withColumn("key", F.when(F.col("key") != 7, F.col("key")))
    seen = {}
    for r in with_group_position(df, ["key"], ["v", "id"], "pos").collect():
        seen.setdefault(r["key"], []).append((r["pos"], r["v"], r["id"]))
    assert None in seen and len(seen[0]) >= 1000
    for rows in seen.values():
        rows.sort()
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)


def test_running_sums_overall_and_per_key(spark):
    df = skewed(spark)
    total = 0
    for r in with_running_sums(df, ["v", "id"], {"s": "v"}).orderBy("v", "id").collect():
        total += r["v"]
        assert r["s"] == total
    per_key = {}
    for r in with_running_sums(df, ["v", "id"], {"s": "v"}, keys=["key"]).orderBy("v", "id").collect():
        per_key[r["key"]] = per_key.get(r["key"], 0) + r["v"]
        assert r["s"] == per_key[r["key"]]


def test_positions_of_an_empty_table(spark):
    empty = skewed(spark).filter("id < 0")
    assert with_position(empty, ["id"], "pos").count() == 0
    assert with_running_sums(empty, ["id"], {"s": "v"}).count() == 0


def test_posting_blocks_split_a_hot_key(spark):
    blocks = aggregates.posting_blocks(skewed(spark), "key", "id", block=100).collect()
    hot = sorted((r["block"], r["values"]) for r in blocks if r["key"] == 0)
    assert max(len(v) for _, v in hot) <= 100
    joined = [v for _, values in hot for v in values]
    assert joined == sorted(joined) and len(joined) == 1040


def test_medians_of_odd_and_even_counts(spark):
    df = spark.createDataFrame([(1.0, 5), (2.0, 5), (4.0, 5), (10.0, None)], "a double, b int")
    found = {r["column"]: r["median"] for r in aggregates.medians(df, ["a", "b"]).collect()}
    assert found == {"a": 3.0, "b": 5.0}


def test_medians_of_many_values_with_a_hot_one(spark):
    import numpy as np

    rng = np.random.default_rng(11)
    smooth, hot = rng.normal(size=20_001), rng.integers(0, 1000, size=20_001).astype(float)
    hot[::3] = 500.0
    df = spark.createDataFrame(list(zip(smooth.tolist(), hot.tolist())), "a double, b double")
    for limited in (10_000, 50):
        found = {r["column"]: r["median"] for r in aggregates.medians(df, ["a", "b"], limited).collect()}
        assert found == {"a": float(np.median(smooth)), "b": float(np.median(hot))}
    assert aggregates.medians(df.filter("a > 100"), ["a", "b"]).count() == 0


def test_stratified_folds_share_every_class(spark):
    folds = ranking.stratified_folds(skewed(spark), "key", "id", 5).groupBy("key", "fold").count().collect()
    sizes = {}
    for r in folds:
        sizes.setdefault(r["key"], []).append(r["count"])
    assert all(max(s) - min(s) <= 1 for s in sizes.values() if len(s) == 5)


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 0.999, 1.0])
def test_ordered_split_finds_its_border(spark, share):
    """A third of the rows share the first column, some have none."""
    from brightloom.operators.ranking import ordered_split

    first = F.when(F.col("id") % 3 == 0, 500).when(F.col("id") % 11 == 1, F.lit(None)).otherwise((F.col("id") * 37) % 1000)
    df = spark.range(3000).select(first.cast("double").alias("a"), F.col("id").alias("b"))
    got = ordered_split(df, ["a", "b"], share).collect()
    ranked = sorted(got, key=lambda r: (r["a"] is not None, r["a"] or 0.0, r["b"]))
    assert [r["split"] for r in ranked] == ["test"] * int(3000 * share) + ["train"] * (3000 - int(3000 * share))


def test_profile_sketches_are_close(spark):
    from brightloom.operators.aggregates import profile

    df = spark.range(60_000).select((F.col("id") % 20_000).alias("a"), F.when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("b"), F.lit(None).cast("double").alias("c"))
    exact = {r["column"]: r for r in profile(df).collect()}
    assert [exact[c]["n_distinct"] for c in "abc"] == [20_000, 30_000, 0]
    for r in profile(df, sketch=12).collect():
        assert abs(r["n_distinct"] - exact[r["column"]]["n_distinct"]) <= 5 * 1.04 / 64 * exact[r["column"]]["n_distinct"]
        assert r["n_present"] == exact[r["column"]]["n_present"]
