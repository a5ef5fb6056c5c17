from __future__ import annotations

import base64
import random
from collections import defaultdict
from hashlib import sha256
from zlib import crc32

import pytest

from brightloom.llm import prefixes

SCHEMA = "conv_id long, turn long, role string, text string, depth int, path string, segment int, next string, anchor string"


def token(role, text):
    digest = sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
    return base64.b64encode(digest + len(text).to_bytes(5, "big")).decode()


def plain(rows):
    """All nodes by listing every prefix of every conversation."""
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            own[conv_id].append(((turn is not None, turn or 0, token(role, text)), (role, text)))
    own = {c: [said for _, said in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        turns = tuple(own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + turns[h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
        ends[turns].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    below: dict = {}
    for path in sorted(members, key=len, reverse=True):
        kids = children[path]
        saved = (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
        below[path] = (sum(below[k][0] for k in kids) if kids else 1, saved + sum(below[k][1] for k in kids))
    return sorted(
        (min(m), len(path), min(members[path[:-1]]) if path else -1, len(m), len(children[path]), *below[path],
         sha256(",".join(map(str, sorted(ends[path]))).encode()).hexdigest())
        for path, m in members.items())


def found(spark, rows, segment):
    df = spark.createDataFrame([(*r, 1, "p", 2, "n", "a") for r in rows], SCHEMA).repartition(6)
    return sorted(tuple(-1 if v is None else v for v in r) for r in prefixes.trie(df, segment).collect())


def talks(seed):
    draw = random.Random(seed)
    texts = ["a", "bé", "", None, "long " * 40]
    rows = []
    for c in range(260):
        for t in range(draw.randint(1, 14)):
            rows.append((c, t if t or c % 5 else None, draw.choice(["user", "bot", None]), draw.choice(texts[:2]) if t < 3 else draw.choice(texts)))
    rows += [(None, 1, "user", "left out"), (-7, 1, "user", "a"), (10**15, 0, None, None)]
    rows += [(300 + i, t, "user", "copy %d" % t) for i in range(120) for t in range(9)]  # a large group of copies
    rows += rows[:30]  # repeated rows are turns of their own
    return rows


@pytest.mark.parametrize("segment", [6, 7, 512])
def test_equals_listing_all_prefixes(spark, segment):
    rows = talks(segment)
    assert found(spark, rows, segment) == plain(rows)


def test_one_conversation_holds_most_rows(spark):
    long = [(100, t, "user", f"turn {t}") for t in range(400)]
    rows = long + [(101, *r[1:]) for r in long[:399]] + [(102, *r[1:]) for r in long] + [(103, 5, "x", "y")]
    rows += [(105, t, "user", f"turn {t}" if t < 300 else "other") for t in range(310)]
    assert found(spark, rows, 6) == plain(rows)


def test_conversations_around_the_ends_of_segments(spark):
    rows = [(c, t, "user", "same") for c in range(30) for t in range(c)]
    assert found(spark, rows, 6) == plain(rows)


def test_empty_table(spark):
    assert found(spark, [], 512) == []
    assert found(spark, [(None, 1, "a", "b")], 512) == []
