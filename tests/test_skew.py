from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from brightloom.operators.skew import hot_keys, key_hash, salted_join


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id"))
    return spark.range(30_000).withColumn("key", key.cast("long"))


def test_sketch_finds_the_hot_key_and_no_rare_one(spark, rows):
    hashes = {r[0] for r in spark.createDataFrame([(7,), (None,)], "key long").select(key_hash(["key"])).collect()}
    assert set(hot_keys(rows, ["key"])) == hashes
    assert hot_keys(rows.filter("id % 3 = 1 AND key IS NOT NULL"), ["key"]) == []
    assert hot_keys(rows.limit(0), ["key"]) == []


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_equals_plain_join(spark, rows, how):
    right = spark.range(0, 20_000, 2).select(F.col("id").alias("key"), (F.col("id") * 2).alias("value")).unionByName(
        spark.createDataFrame([(7, 1), (7, 2), (None, 3)], "key long, value long"))
    got = salted_join(rows, right, ["key"], ["id"], how, pieces=8)
    assert Counter(map(tuple, got.select(sorted(got.columns)).collect())) == Counter(
        map(tuple, rows.join(right, "key", how).select(sorted(got.columns)).collect()))


def test_hot_rows_are_dealt_over_pieces(spark, rows):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        right = spark.createDataFrame([(7, 1)], "key long, value long")
        got = salted_join(rows.filter("key IS NOT NULL"), right, ["key"], ["id"], "left", pieces=32)
        held = got.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert held < 30_000 / 4  # the hot key alone has a third; 8 partitions


def test_sides_that_must_be_kept_are_refused(spark, rows):
    with pytest.raises(ValueError):
        salted_join(rows, rows, ["key"], ["id"], "full", hot=[])
