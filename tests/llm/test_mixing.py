from __future__ import annotations

import math
from collections import defaultdict

from brightloom.llm.mixing import mix, source_targets


def water(sizes):
    """Targets by sharing again and again what the caps take away."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    total, fixed, free = sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(fixed.values())) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {**fixed, **{s: weight[s] * level for s in free}}
        fixed |= {s: 3 * sizes[s] for s in over}
        free -= over
    return fixed


def test_targets_equal_repeated_sharing(spark):
    for sizes in ({"a": 5, "b": 500, "c": 20, "d": 3, None: 40, "é": 1000}, {"a": 0, "b": 0}, {"x": 9}, {None: 4, "b": 100}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in source_targets(df, "source", "size").collect()}
        assert got.keys() == sizes.keys()
        for s, t in water(sizes).items():
            assert math.isclose(got[s], t, rel_tol=1e-12), (sizes, s)


def test_mix_near_target_and_repeatable(spark):
    rows = [(i if i % 50 else None, " ".join(["w"] * (i % 40)) if i % 7 else None, ["hot", "hot", None, "b"][i % 4], 1) for i in range(2000)]
    rows += rows[:20]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int").repartition(7)
    first, second = ([tuple(r) for r in mix(d).collect()] for d in (docs, docs.coalesce(1)))
    assert sorted(map(str, first)) == sorted(map(str, second)) and len(first) == len(rows)
    taken, target = defaultdict(int), {}
    for doc_id, size, source, source_size, goal, copies, words in first:
        assert words == size * copies <= 3 * size
        taken[source] += words
        target[source] = goal
    for source, goal in target.items():
        assert abs(taken[source] - goal) <= 40


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
