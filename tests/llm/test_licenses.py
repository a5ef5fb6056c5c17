from __future__ import annotations

import random
import re

from brightloom.llm import licenses


def shingles(text):
    words = re.findall("[a-z0-9]+", (text or "").lower())
    return [" ".join(words[i:i + 5]) for i in range(len(words) - 4)]


def brute(rows, templates, percent=80):
    out = []
    for doc_id, text in rows:
        own = shingles(text)
        for name, t in templates.items():
            want = set(shingles(t))
            have = want & set(own)
            if want and 100 * len(have) >= percent * len(want):
                out.append((doc_id, name, len(want), len(have), min(own.index(s) for s in have)))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    draw = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)] + ["licensed", "under", "the", "license", "version"]

    def noise(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    rows = [(i, noise(draw.randrange(0, 60)) + " " + t + "; " + noise(draw.randrange(0, 60))) for i, t in enumerate(list(licenses.TEMPLATES.values()) * 12)]
    long_ = licenses.TEMPLATES["mit notice"].split()
    rows += [(500 + i, noise(9) + " " + " ".join(w if k != i * 5 else "edit" for k, w in enumerate(long_)) + noise(9)) for i in range(9)]
    rows += [(900, None), (901, ""), (902, "Released under the MIT License"), (902, "Released under the MIT License"), (None, "RELEASED under the mit-license!"),
             (903, "under the"), (904, noise(40000) + " licensed under CC BY NC 4.0"), (905, "Released under the"), (906, "é à ü " * 20)]
    df = spark.createDataFrame([(*r, 0, "x") for r in rows], "doc_id long, text string, hits int, words string")
    got = sorted(map(tuple, licenses.scan(df).collect()), key=str)
    assert got == brute(rows, licenses.TEMPLATES)


def test_short_or_no_templates_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    assert licenses.scan(df, templates={"short": "a b c"}).collect() == []
    assert [tuple(r) for r in licenses.scan(df, templates={"one": "b c d e f", "short": "a"}).collect()] == [(1, "one", 1, 1, 1)]
    assert licenses.scan(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = licenses.scan(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "SortMergeJoin" not in plan
