from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brightloom.llm import neighbours
from brightloom.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, rank int, v string"


def brute(rows, k=10):
    usable = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in usable:
        if q % 100 == 0:
            out[q] = sorted((float(np.sqrt(((usable[i] - usable[q]) ** 2).sum())), i) for i in usable if i != q)[:k]
    return out


def found(df, **options):
    out = defaultdict(list)
    for r in sorted(neighbours.search(df, F.col("vec_id") % 100 == 0, **options).collect(), key=lambda r: (r.query_id, r.rank)):
        out[r.query_id].append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_and_scores(spark, sf_dir):
    df = table(spark, "/root/testdata/sf0.1", "embeddings")
    want, got = brute([(r.vec_id, r.embedding) for r in df.collect()]), found(df)
    assert got.keys() == want.keys()
    hits = [len({i for _, i in got[q]} & {i for _, i in want[q]}) / len(want[q]) for q in want]
    assert np.mean(hits) >= 0.9 and all(len(got[q]) == 10 and got[q] == sorted(got[q]) for q in want)


def test_all_lists_and_no_doubt_give_the_exact_result(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 50)
    draw = np.random.default_rng(2)
    vectors = np.round(draw.normal(size=(700, 40)), 2).astype(np.float32)
    vectors[100:350] = vectors[7]  # one vector holds a third of the rows
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    bad = [(1000, None), (1100, [0.0] * 40), (1200, [math.nan] + [1.0] * 39), (1300, [math.inf] + [1.0] * 39), (None, [1.0] * 40), (1400, [None] + [1.0] * 39), (1500, [])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows + bad + rows[:3]], SCHEMA).repartition(5)
    got, want = found(df, probes=1.0), brute(rows)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]], q
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12, atol=0)


def test_few_rows_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0], 1, "x"), (100, [0.0, 1.0], 1, "x"), (3, [1.0], 1, "x")], SCHEMA)
    assert {q: [i for _, i in n] for q, n in found(few).items()} == {0: [100], 100: [0]}
    assert found(few.limit(0)) == {} and found(spark.createDataFrame([(0, None, 1, "x")], SCHEMA)) == {}
    assert found(spark.createDataFrame([(0, [1.0], 1, "x")], SCHEMA)) == {}


def test_tests_abandon_most_candidates_early():
    draw = np.random.default_rng(5)
    block, q = draw.normal(size=(5000, 64)), draw.normal(size=64)
    live = next(iter(neighbours.scan(q[None], block, 10)))
    far = ((block - q) ** 2).sum(1)
    assert set(np.argsort(far)[:10]) <= set(live.tolist()) and len(live) < 50


def test_rotation_keeps_distances():
    r = neighbours.rotation(30)
    assert np.allclose(r @ r.T, np.eye(30))
