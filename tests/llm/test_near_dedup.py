from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from brightloom.llm import near_dedup
from brightloom.llm.common import table
from brightloom.llm.components import components


def brute(texts, size, percent):
    """Components over all pairs that share a shingle."""
    sets, holders = {}, defaultdict(list)
    for k, t in texts.items():
        words = (t or "").encode().lower().split()
        found = {tuple(words[i:i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        sets[k] = found
        for s in found:
            holders[s].append(k)
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    seen = set()
    for ks in holders.values():
        for i, a in enumerate(ks):
            for b in ks[:i]:
                if (a, b) not in seen:
                    seen.add((a, b))
                    if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in texts}


def agree(spark, texts, size, percent):
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df, size=size, percent=percent).collect()}
    assert got == brute(texts, size, percent)


def test_whole_table_equals_brute_force(spark, sf_dir):
    agree(spark, {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}, 3, 85)


def test_chains_groups_and_short_texts(spark):
    draw = random.Random(5)
    base = [f"w{draw.randrange(5000)}" for _ in range(200)]
    texts, now = {}, base
    for i in range(60):  # a chain: each text is a small edit of the one before
        texts[1000 - i] = " ".join(now)
        now = list(now)
        now[draw.randrange(200)] = f"n{i}"
    for i in range(60):  # a group: each is an edit of the same text
        copy = list(base[::-1])
        for _ in range(3):
            copy[draw.randrange(200)] = f"m{i}"
        texts[2000 + i] = " ".join(copy)
    texts |= {1: "a b", 2: "A  B", 3: "b a", 4: "", 5: None, 6: " \t", 7: "é É", 8: "é É", 9: "x " * 30000, 10: "X\n" * 30000}
    agree(spark, texts, 3, 85)
    agree(spark, texts, 5, 80)


def test_rows_without_id_repeated_rows_and_extra_columns(spark):
    rows = [(1, "a b c", 0, 0), (1, "a b c", 0, 0), (None, "a b c", 0, 0), (3, "A B C", 1, 1)]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, digest int, rep int")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([(1, 1, 1, True), (1, 1, 1, True), (None, 1, None, True), (3, 1, 1, False)], key=str)
    assert near_dedup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_registers_merge_and_estimate():
    draw = np.random.default_rng(4)
    a, b = (np.unique(draw.integers(0, 1 << 63, n, dtype=np.uint64)) for n in (3000, 5000))
    union = np.unique(np.concatenate([a, b]))
    ra, rb = near_dedup.registers(a), near_dedup.registers(b)
    assert (near_dedup.registers(union) == np.maximum(ra, rb)).all()
    for shared in (0, 1500, 2700, 3000):
        c = np.concatenate([a[:shared], draw.integers(0, 1 << 63, 3000 - shared, dtype=np.uint64)])
        ratio = near_dedup.log_ratio(np.array([3000.0]), np.array([3000.0]), ra[None], near_dedup.registers(c)[None], 0.8)[0]
        assert (ratio <= near_dedup.DOUBT) == (shared >= 2700)


def test_components_equal_union_find(spark):
    draw = random.Random(9)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 470)] + [(900, 900), (None, 5)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_block_intersections_equal_plain_ones(monkeypatch):
    monkeypatch.setattr(near_dedup, "_SLICE", 7)
    draw = np.random.default_rng(3)
    left, right = ([np.unique(draw.integers(0, 60, n)).astype(np.uint64) for n in draw.integers(1, 40, 12)] for _ in range(2))
    expected = [[len(np.intersect1d(x, y)) for y in right] for x in left]
    assert near_dedup._counts(left, right).astype(int).tolist() == expected
    assert near_dedup._counts([np.array([1], np.uint64)], [np.array([2], np.uint64)]).tolist() == [[0.0]]
