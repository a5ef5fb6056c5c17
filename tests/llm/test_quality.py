from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from brightloom.llm.quality import measures, quality

TEXTS = [
    None, "", "   \n\t ", "one", "a b c d e a b c d e", "x x x x x x x", "one two\nthree\n\none two\n \n", "#a $b | c...\n- d\n* e",
    "tab\tand\x0bvertical\x0cfeed\r\nend", "é ü ñ nbsp em", "w " * 4000, " ".join(str(i % 977) for i in range(20000)),
    "the cat and the dog and the bird went to the sea in a boat of wood", "same same", "same same",
]


def brute(text):
    text = text or ""
    words = [w for w in __import__("re").split("[ \t-\r]+", text) if w]
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_equal_brute_force(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id long, text string")
    m = measures(F.col("text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for row in df.select("id", m.alias("m")).collect():
        assert tuple(row.m[n] for n in names) == brute(TEXTS[row.id]), row.id


def test_verdicts_and_clashing_columns(spark):
    good = "the cat and the dog and the bird went to the sea in a boat of wood"
    rows = [(1, good, 7), (None, good, None), (2, None, 1), (3, "a b c", 1), (4, "w " * 40, 1), (5, "#$% | & x y z q r s t u v", 2)]
    got = quality(spark.createDataFrame(rows, "doc_id long, text string, quality int"))
    assert got.columns == ["doc_id", "text", "quality"]
    assert {(r.doc_id, r.quality.base_failed, r.quality.kept) for r in got.collect()} == {
        (1, False, True), (None, False, True), (2, True, False), (3, True, False), (4, True, False), (5, False, False)}


def test_empty_table(spark):
    assert quality(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = quality(spark.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Exchange" not in plan
