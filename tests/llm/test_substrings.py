from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from brightloom.llm import substrings
from brightloom.llm.common import table


def brute(rows):
    """Result of every row, from the first holder of each string of 50 bytes."""
    first, out = {}, []
    for doc_id, text in rows:
        b = (text or "").encode()
        for i in range(len(b) - 49):
            s = b[i:i + 50]
            first[s] = min(first.get(s, doc_id), doc_id)
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 49):
            if first[b[i:i + 50]] < doc_id:
                gone[i:i + 50] = True
        rest = np.frombuffer(b, np.uint8)[~gone].tobytes()
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((doc_id, len(b), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest()))
    return sorted(out)


def agree(spark, rows, parts=4):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, bucket string, kind int").repartition(parts)
    got = substrings.dedup(df).drop("kept").collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_whole_table_equals_brute_force(spark, sf_dir):
    agree(spark, [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").collect()])


def test_planted_and_odd_texts(spark, monkeypatch):
    draw = random.Random(3)

    def noise(n):
        return "".join(draw.choice("abcdeéß ") for _ in range(n))

    shared, rows = noise(120), []
    for i in range(40):
        cut = draw.randrange(0, 60)
        rows.append((i * 3 % 41, noise(draw.randrange(0, 90)) + shared[cut:cut + draw.randrange(40, 60)] + noise(draw.randrange(0, 90))))
    rows += [(100, "x" * 300), (101, "x" * 49), (102, "x" * 50), (103, "x" * 51 + "y"), (104, None), (105, ""), (106, "\0" * 80), (107, "\0" * 30 + noise(60)),
             (108, shared), (109, shared), (109, shared), (110, shared[:50]), (111, shared[:49]), (112, shared * 3), (50, "ab" * 100), (51, "ba" * 100),
             (100, "q" + shared), (113, noise(40000)), (114, "é" * 40)]
    agree(spark, rows)


def test_many_buckets(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(substrings, "BUCKET_BYTES", 5000)
    agree(spark, [(r.doc_id, r.text) for r in table(spark, sf_dir, "documents").limit(80).collect()])


def test_rows_without_id_and_empty_table(spark):
    text = "the same long text of more than fifty bytes, for all rows here alike"
    got = substrings.dedup(spark.createDataFrame([(None, text), (7, text), (None, "short")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.n_bytes, r.n_removed) for r in got) == [(False, 68, 0), (True, 5, 0), (True, 68, 68)]
    assert substrings.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_ids_that_are_no_numbers_and_clashing_columns(spark):
    text = "the same long text of more than fifty bytes, for all rows here alike"
    rows = [("b7", text, 1, 2, 3, 4), ("7", text, 1, 2, 3, 4)]
    got = substrings.dedup(spark.createDataFrame(rows, "doc_id string, text string, `order` int, tag int, bucket int, kind int")).collect()
    assert sorted((str(r.doc_id), r.n_removed) for r in got) == [("7", 0), ("None", 68)]


def test_multikey_order_is_the_order_of_bytes():
    rows = np.random.default_rng(1).integers(0, 3, (500, 20)).astype(np.uint8)
    order = substrings.multikey_order(substrings._words(rows))
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)
