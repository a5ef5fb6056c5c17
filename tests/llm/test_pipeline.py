from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as pipeline
from brightloom.llm.common import table
from test_mixing import water
from test_near_dedup import brute
from test_packing import PATH, check
from test_secrets import plain_base
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    out = [table(spark, sf_dir, "documents").cache()]
    for _, stage in pipeline.STAGES:
        out.append(stage(spark, out[-1], sf_dir).cache())
    rows = [d.collect() for d in out]
    for d in out:  # later tests plan without these
        d.unpersist()
    return rows


def test_language_stage_scores_every_text_once(spark, sf_dir):
    found = pipeline.identify_language(spark, table(spark, sf_dir, "documents"), sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") + plan.count("MapInPandas") == 1


def test_stages_are_the_named_ones():
    assert len(pipeline.STAGES) == 5 and pipeline.ORACLE_SQL is None


def test_language_stage_keeps_clean_documents(steps):
    before, after = {r.doc_id: r for r in steps[0]}, {r.doc_id: r for r in steps[1]}
    assert list(steps[1][0].asDict()) == list(pipeline.COLUMNS)
    gone = before.keys() - after.keys()
    assert all(after[k] == before[k] for k in after) and len(gone) <= 0.05 * len(before)


def test_near_duplicate_stage_equals_brute_force(steps):
    groups = brute({r.doc_id: r.text for r in steps[1]}, 5, 80)
    assert sorted(r.doc_id for r in steps[2]) == sorted(k for k, (_, root) in groups.items() if root == k)


def test_secret_stage_leaves_no_pattern_and_all_documents(steps):
    before = {r.doc_id: r.text for r in steps[2]}
    assert before.keys() == {r.doc_id for r in steps[3]}
    for r in steps[3]:
        assert r.n_chars == len(r.text) and (r.text == before[r.doc_id] or "[SECRET]" in r.text)
        assert plain_base(r.text) == []


def test_mixing_stage_meets_targets(steps):
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in steps[3]:
        sizes[r.source] += len(r.text.encode().split())
    for r in steps[4]:
        taken[r.source] += len(r.text.encode().split())
    longest = max(len(r.text.encode().split()) for r in steps[3])
    for source, target in water(sizes).items():
        assert abs(taken[source] - target) <= longest
    assert max(Counter(r.doc_id for r in steps[4]).values()) <= 3


def test_packing_stage_round_trip(steps):
    texts = {r.doc_id: r.text for r in steps[4]}
    copies = Counter(r.doc_id for r in steps[4])
    rows = steps[5]
    tokenizer = Tokenizer.from_file(PATH)
    first = {}
    for r in rows:
        first.setdefault((r.doc_id, r.piece), r)
    assert Counter((r.doc_id, r.piece) for r in rows) == {k: copies[k[0]] for k in first}
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for found in places.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 4096
    for doc_id, text in texts.items():
        n = len(tokenizer.encode(text or "", add_special_tokens=False).ids) + 1
        assert sum(r.length for (d, _), r in first.items() if d == doc_id) == n


def test_nulls_repeats_and_empty_tables_go_through(spark, sf_dir):
    good = "the boat went over the sea and the cat came home to the house of the old man " * 3
    digest = hashlib.sha1(b"x").hexdigest()
    rows = [(1, good, "en", "a", 9), (1, good, "en", "a", 9), (None, good, None, None, None), (2, None, "en", "a", None), (3, "", None, None, 0),
            (4, good + f'token = "{digest}"', None, "b", 1), (5, "123 456", "en", "b", 1), (6, "la maison " * 9000, "fr", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for docs in (docs, docs.limit(0)):
        for _, stage in pipeline.STAGES:
            docs = stage(spark, docs, sf_dir)
            docs.collect()
