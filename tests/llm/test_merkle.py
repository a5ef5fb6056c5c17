from __future__ import annotations

import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest

from brightloom.llm import merkle

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, digest string, place int, root string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def plain(rows):
    """Leaf, subroot, root, proof and folded root of every row, level by level over whole lists."""

    def leaf(doc_id, source, lang, n_chars, text):
        return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))

    def climb(digests, at, folded, proof):
        while len(digests) > 1:
            low = at - at % 3
            run = digests[low:low + 3]
            left, right = run[:at - low], run[at - low + 1:]
            proof += left + right
            folded = h(*left, folded, *right)
            digests = [h(*digests[i:i + 3]) for i in range(0, len(digests), 3)]
            at //= 3
        return digests[0], folded

    sources = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        clean = text if text is None or doc_id is None or crc32(str(doc_id).encode()) % 2 else text.replace("\n", "")
        sources[source].append((doc_id, leaf(doc_id, source, lang, n_chars, text), leaf(doc_id, source, lang, n_chars, clean)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for leaves in sources.values():
        leaves.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    subroots = [climb([x[1] for x in sources[s]], 0, "", [])[0] for s in names]
    out = []
    for i, s in enumerate(names):
        for at, (doc_id, own, other) in enumerate(sources[s]):
            proof: list[str] = []
            subroot, folded = climb([x[1] for x in sources[s]], at, other, proof)
            root, folded = climb(subroots, i, folded, proof)
            out.append((doc_id, own, subroot, root, h(*proof), folded))
    return sorted(out, key=str)


def found(spark, rows, height):
    docs = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    got = merkle.check(docs, height).collect()
    for r in got:
        assert (r.changed is None) == (r.copied == [])
        if r.copied:  # one new node a level, and nothing else
            assert len(r.copied) == 1 + len(r.siblings) // 2 and r.copied[0] == r.changed and r.copied[-1] == r.version_root != r.root
    return sorted(((r.doc_id, r.digest, r.subroot, r.root, h(*r.siblings), r.version_root) for r in got), key=str)


@pytest.mark.parametrize("height", [1, 2, 6])
def test_equals_plain_lists(spark, height):
    draw = random.Random(height)
    rows = [
        (i if i % 41 else None, draw.choice(["a\nb", "é\n" * 9, "", None, "one", "x" * 70_000]) if i % 9 else f"text\n{i}",
         draw.choice(["en", None]), draw.choice(["hot"] * 8 + [None, "", "é", "z", "+", "one"]), draw.choice([None, i]))
        for i in range(120)]
    rows += rows[:15] + [(500, "alone\n", "fr", "lonely", 3)]
    assert found(spark, rows, height) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_sizes_around_full_levels(spark, n):
    rows = [(i, f"a\n{i}", None, "s", i) for i in range(n)]
    assert found(spark, rows, 1) == plain(rows)


def test_empty_table_gives_empty_one(spark):
    assert merkle.check(spark.createDataFrame([], SCHEMA)).collect() == []


def test_versions_share_untouched_nodes():
    tree = merkle.tree([h(str(i)) for i in range(20)], 3)
    new = merkle.changed_leaf(tree, merkle.steps_of(16, 3), "other")[-1]
    assert new.children[0] is tree.children[0]
    assert new.children[1].children[0] is tree.children[1].children[0]
    assert new.children[1].children[2].children[0] is tree.children[1].children[2].children[0]
