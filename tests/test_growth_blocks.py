"""Blocks of vectors are compared, moved and merged without work that grows faster than their pairs."""

from __future__ import annotations

import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from brightloom.operators import knn
from brightloom.session import checkpointed, shuffles_dropped


def sides(q, t):
    left = pa.table({"vector_id": np.arange(len(q)), "bound": np.full(len(q), np.inf), "_v": q.tolist()})
    return left, pa.table({"train_id": np.arange(len(t)), "ids": [[i] for i in range(len(t))], "_v": t.tolist()})


def odd_vectors(kind, rng):
    x = rng.normal(size=(1500, 32))
    if kind == "outliers":
        x[::100] *= 1e5
    if kind == "one large component":
        x[:, 3] *= 1e6
    if kind == "far off":
        x += 1e9
    if kind == "ties":
        x = np.round(x)
    return np.unique(x, axis=0)


@pytest.mark.parametrize("kind", ["even", "outliers", "one large component", "far off", "ties"])
def test_manhattan_neighbours_in_many_dimensions(kind, monkeypatch):
    """w01_nearest_per_row: every pair was worked out in doubles, component by component."""
    x, worked_out = odd_vectors(kind, np.random.default_rng(6)), []
    for name in ("_pairwise", "_manhattan"):
        if hasattr(knn, name):
            monkeypatch.setattr(knn, name, lambda *a, f=getattr(knn, name): worked_out.append((out := f(*a)).size) or out)
    found = knn._block_best(4, 1)(*sides(x[:400], x)).to_pydict()
    if kind == "even":
        assert sum(worked_out) < 0.2 * 400 * len(x)
    for i in (0, 100, 233, 399):
        far = np.abs(x - x[i]).sum(axis=1)
        assert [(n["distance"], n["train_id"]) for n in found["near"][i]] == sorted(zip(far.tolist(), range(len(x))))[:4]


def frame(spark, x, name):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], f"{name} long, features array<double>")


@pytest.mark.parametrize("p", [1, 2])
def test_hashed_neighbours_carry_a_vector_to_few_blocks(spark, monkeypatch, p):
    """l08_hashed_neighbours: a query went to each of 96 buckets; what it finds is still the best of all of them."""
    x, carried, compared = np.random.default_rng(9).normal(size=(1000, 8)).astype(np.float32).astype(float), [], knn._compared
    x[500:520] = x[:20]

    def counted(wanted, placed, *rest):
        carried.append((wanted.count(), placed.count()))
        return compared(wanted, placed, *rest)

    monkeypatch.setattr(knn, "_compared", counted)
    monkeypatch.setattr(knn, "BLOCK_BYTES", 8 * 8 * 256)
    monkeypatch.setattr(knn, "MERGED", 256)
    rows = frame(spark, x, "t")
    found = knn.hashed_neighbours(rows.withColumnRenamed("t", "q"), rows, 5, "q", "t", p=p, exclude_self=True, bucket=16).collect()
    assert sum(asked for asked, _ in carried) < 48 * len(x)
    tables = knn.ProjectionTables(frame(spark, np.unique(x, axis=0), "t"), "features", len(x), bucket=16)
    own, probed = tables.codes(x, 1), tables.codes(x, 8)
    got = {}
    for r in sorted(found, key=lambda r: (r["q"], r["rank"])):
        got.setdefault(r["q"], []).append(r["train_id"])
    for i in range(0, len(x), 7):
        far = np.abs(x - x[i]).sum(axis=1) if p == 1 else np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        met = np.flatnonzero(np.isin(own, probed[i]).any(axis=1))
        assert len(met) > 6
        assert got[i] == [j for _, j in sorted(zip(far[met], met.tolist())) if j != i][:5]


def test_shuffles_are_dropped_when_their_job_ends(spark):
    def files():
        return sum(1 for top in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
                   for name in Path(top).rglob("shuffle_*"))

    before, name = files(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    with shuffles_dropped(spark):
        kept = checkpointed(spark.range(50_000).groupBy((F.col("id") % 1000).alias("k")).count())
    until = time.time() + 20
    while files() > before and time.time() < until:
        time.sleep(0.2)
    assert files() <= before and kept.count() == 1000 and spark.conf.get(name, None) == was
