from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from brightloom.llm import packing
from brightloom.llm.common import table

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_words_give_the_ids_of_the_text(tokenizer, spark, sf_dir):
    texts = [r.text for r in table(spark, sf_dir, "documents").limit(60).collect()]
    texts += ["", " ", "It's we'll 12a34 — don't", "a b c　d\x1ce\x85f", "é é ́x ﬁ İ ΣΑΣ", "x<|endoftext|>y <|startoftext|>", "日本語 テキスト", "a\tb\x0bc\x0cd\r\ne", "'s 's'S I'M", "​ ﻿", "😀😀 👩‍👩‍👧"]
    ids = packing.Ids(PATH)
    for t in texts:
        assert ids(t).tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 1], t[:80]


def test_least_squares_equals_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        a, b = rng.random((5, 4)), rng.normal(size=5)
        best = min((np.linalg.norm(a @ x - b) for mask in range(16) for x in [_solve(a, b, mask)] if (x >= 0).all()))
        assert np.linalg.norm(a @ packing.nnls(a, b) - b) <= best + 1e-9


def _solve(a, b, mask):
    at = [i for i in range(a.shape[1]) if mask >> i & 1]
    x = np.zeros(a.shape[1])
    if at:
        x[at] = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
    return x


@pytest.mark.parametrize("capacity,grid", [(4096, 256), (10, 64), (1, 64), (100, 50), (4096, 64)])
def test_plan_uses_each_piece_once(capacity, grid):
    for seed in range(8):
        draw = random.Random(seed)
        histogram = Counter(min(capacity, max(1, int(draw.paretovariate(0.9) * capacity / 20))) for _ in range(draw.choice([0, 1, 50, 3000])))
        if seed == 7 and capacity > 3:
            histogram[capacity // 3] += 100000
        runs, used, total = packing.plan(histogram, capacity, grid), Counter(), sum(n * c for n, c in histogram.items())
        for lengths, repeats in runs:
            assert 0 < sum(lengths) <= capacity and repeats > 0
            for n in lengths:
                used[n] += repeats
        assert used == +Counter(histogram)
        sequences = sum(r for _, r in runs)
        # No worse than half full but for one, as any best-fit packing.
        assert sequences <= max(1, 2 * -(-total // capacity)) or not total


def check(rows, texts, tokenizer, capacity):
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        found = sorted(by_doc[doc_id], key=lambda r: r.piece)
        assert [r.start for r in found] == list(range(0, len(ids), capacity))
        for r in found:
            part = ids[r.start:r.start + capacity]
            assert r.length == len(part) and r.ids_crc32 == zlib.crc32(np.array(part, dtype="<u4").tobytes())
    return len(by_sequence)


def test_round_trip(spark, sf_dir, tokenizer):
    docs = table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack(docs.repartition(6), PATH).collect()
    assert len({(r.doc_id, r.piece) for r in rows}) == len(rows)
    n = check(rows, texts, tokenizer, 4096)
    assert n <= 1.02 * sum(r.length for r in rows) / 4096 + 1


def test_edge_cases(spark, tokenizer):
    texts = {1: None, 2: "", 3: "word " * 30000, 4: "a b c", 5: "a b c", None: "no id"}
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in texts.items()], "doc_id long, text string, piece int, length int")
    check(packing.pack(df, PATH).collect(), texts, tokenizer, 4096)
    check(packing.pack(df, PATH, capacity=2).collect(), texts, tokenizer, 2)
    assert len(packing.pack(df.union(df), PATH).collect()) == 2 * len(packing.pack(df, PATH).collect())
    assert packing.pack(df.limit(0), PATH).collect() == []
