"""Hash tree over a data set, with a proof and, for a changed row, a version of the tree for every row.

Leaves are numbered inside their group and cut into aligned blocks of ``FAN ** HEIGHT``; a task builds the
subtree of a block, and the roots of blocks are the leaves of the next round, so the number of rounds grows
with the logarithm of the largest group. The roots of the groups are the leaves of one more tree.

A changed leaf makes a new version of its block that shares every untouched node: only the ancestors of the
leaf are copied. Above the block the version goes on along the path of the block, which comes down the
rounds as one row per block, so that versions meet neither in a task nor in the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from hashlib import sha256
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.llm.common import written
from brightloom.operators.positions import with_group_position, with_position

FAN = 3
#: Levels of a block, which holds 729 leaves.
HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


class Node(NamedTuple):
    """A node that never changes; versions of a tree share nodes."""

    digest: str
    children: tuple[Node, ...] = ()


def digest_of(parts: Iterable[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def parent_of(children: Sequence[Node]) -> Node:
    return Node(digest_of(c.digest for c in children), tuple(children))


def tree(digests: Iterable[str], height: int) -> Node:
    """The tree over ``digests``; a last run that is short, or a lone node, gets a parent of its own."""
    nodes = [Node(d) for d in digests]
    for _ in range(height):
        nodes = [parent_of(nodes[i:i + FAN]) for i in range(0, len(nodes), FAN)]
    return nodes[0]


def height_of(block: int, leaves: int, height: int) -> int:
    """Levels of a block. Only the first block of a group can be the whole group, and then it ends at its root."""
    full = 0
    while FAN ** full < leaves:
        full += 1
    return full if block == 0 else height


def steps_of(place: int, height: int) -> list[int]:
    """Which child to take at every level, from the root down to the leaf at ``place``."""
    return [place // FAN ** level % FAN for level in reversed(range(height))]


def siblings_of(root: Node, steps: Sequence[int]) -> list[str]:
    """Digests left and right of the path, as ``left, right`` for each level from the leaf up."""
    found: list[str] = []
    for at in steps:
        digests = [c.digest for c in root.children]
        found = ["".join(digests[:at]), "".join(digests[at + 1:]), *found]
        root = root.children[at]
    return found


def changed_leaf(root: Node, steps: Sequence[int], digest: str) -> list[Node]:
    """The nodes that a version with another leaf does not share: the leaf and its copied ancestors, up to the new root."""
    if not steps:
        return [Node(digest)]
    at, children = steps[0], root.children
    below = changed_leaf(children[at], steps[1:], digest)
    return [*below, parent_of([*children[:at], below[-1], *children[at + 1:]])]


def folded(digest: str, siblings: Sequence[str]) -> Iterator[str]:
    """Digests of the ancestors that a leaf has with these siblings."""
    for left, right in zip(siblings[::2], siblings[1::2]):
        digest = digest_of((left, digest, right))
        yield digest


def field(value: Column) -> Column:
    """A value as text that no other value shares: ``-`` for null, else its UTF-8 length, a colon and itself."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf(columns: Sequence[Column]) -> Column:
    """Digest of a row, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[field(c) for c in columns]), 256))


def _blocks(level: DataFrame, height: int) -> DataFrame:
    return level.withColumn("block", F.floor(F.col("place") / FAN ** height).cast("long"))


def _ordered(block: pd.DataFrame, number: int, height: int) -> tuple[pd.DataFrame, Node, int]:
    block = block.sort_values("place").reset_index(drop=True)
    height = height_of(number, len(block), height)
    return block, tree((d.hex() for d in block["digest"]), height), height


def _roots(height: int):
    def run(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
        _, root, _ = _ordered(block, key[1], height)
        return pd.DataFrame({"group": [key[0]], "place": [key[1]], "digest": [bytes.fromhex(root.digest)]})

    return run


def rounds(leaves: DataFrame, height: int = HEIGHT) -> list[DataFrame]:
    """The leaves (``group, place, digest``, more) and, for every further round, the roots of the blocks before."""
    found = [leaves]
    while (found[-1].agg(F.max("place")).first()[0] or 0) > 0:
        blocks = _blocks(found[-1].select("group", "place", "digest"), height)
        up = blocks.groupBy("group", "block").applyInPandas(_roots(height), "group string, place long, digest binary")
        found.append(written(up, "tree"))
    return found


_PATH = ("siblings", "subroot", "root", "copied", "version_root")
_PATH_TYPES = "siblings array<string>, subroot string, root string, copied array<string>, version_root string"


def _paths(height: int, more: Sequence[str]):
    """Siblings up to the root for the nodes of a block: those inside, then those of the block itself."""

    def run(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block, root, levels = _ordered(block, key[1], height)
        upper, subroot, top = list(above["siblings"][0]), above["subroot"][0], above["root"][0]
        out: dict[str, list] = {c: block[c].tolist() for c in more} | {c: [] for c in _PATH}
        changes = out.get("changed", [None] * len(block))
        for place, (digest, change) in enumerate(zip(block["digest"], changes)):
            steps = steps_of(place, levels)
            siblings = siblings_of(root, steps) + upper
            if change is None:
                copied, version = [], [digest.hex(), *folded(digest.hex(), siblings)][-1]
            else:
                copied = [n.digest for n in changed_leaf(root, steps, change.hex())]
                copied += folded(copied[-1], upper)
                version = copied[-1]
            for name, value in zip(_PATH, (siblings, subroot, top, copied, version)):
                out[name].append(value)
        return pd.DataFrame(out)

    return run


def paths(levels: Sequence[DataFrame], top: DataFrame, height: int = HEIGHT) -> DataFrame:
    """The leaves with their siblings up to the root, and the version that their change makes.

    ``top`` has ``group, siblings, subroot, root`` for each group. Rounds are walked from the last one down;
    the rows of a block get the one row that is the path of the block.
    """
    above = top.withColumn("place", F.lit(0).cast("long"))
    for level in reversed(levels[:-1] or levels):
        more = [c for c in level.columns if c != "digest"] if level is not levels[0] else level.columns
        types = ", ".join(f"`{c}` {kind}" for c, kind in level.dtypes if c in more)
        over = above.select("group", F.col("place").alias("block"), "siblings", "subroot", "root")
        pairs = _blocks(level, height).groupBy("group", "block").cogroup(over.groupBy("group", "block"))
        above = pairs.applyInPandas(_paths(height, more), f"{types}, {_PATH_TYPES}")
        if level is not levels[0]:
            above = written(above.drop("copied", "version_root"), "paths")
    return above


def manifest(rows: DataFrame, key: str, group: str, digest: Column, changed: Column, height: int = HEIGHT) -> DataFrame:
    """One row for each row: ``key, group, place, digest, changed, siblings, subroot, root, copied, version_root``.

    ``digest`` is the leaf, ``changed`` the leaf of the row as found again (null: as it was). Leaves ascend by
    ``key`` and digest inside their group, groups by their bytes; null comes first in both. ``siblings`` are the
    digests left and right of the path, level by level from the leaf to the root; ``copied`` are the nodes that
    the version of a changed row does not share with the tree, from the new leaf to the new root. Rows alike in
    all fields are leaves side by side; a group that holds most rows is cut into blocks like any other; an empty
    table gives an empty one.
    """
    named = F.coalesce(F.concat(F.lit("+"), F.col(group).cast("string")), F.lit(""))  # "" is the null group
    differs = F.when(changed != digest, changed)
    leaves = rows.select(F.col(key).alias("key"), named.alias("group"), digest.alias("digest"), differs.alias("changed"))
    # Written first: the sort reads its input twice, and the texts are far larger than their digests.
    numbered = with_group_position(written(leaves, "digests"), ["group"], [F.col("key").asc_nulls_first(), "digest"], "place")
    levels = rounds(written(numbered, "leaves"), height)
    subroots = with_position(levels[-1].select(F.col("group").alias("name"), "digest"), ["name"], "place")
    groups = rounds(written(subroots.select(F.lit("").alias("group"), "place", "digest", "name"), "subroots"), height)
    root = groups[-1].select(
        "group", F.array().cast("array<string>").alias("siblings"), F.lit(None).cast("string").alias("subroot"),
        F.lower(F.hex("digest")).alias("root"))
    top = paths(groups, root if len(groups) > 1 else root.limit(1), height)
    top = top.select(F.col("name").alias("group"), "siblings", F.lower(F.hex("digest")).alias("subroot"), "root")
    found = paths(levels, written(top, "tops"), height)
    back = F.when(F.col("group") != "", F.substring("group", 2, 1 << 30))
    return found.withColumns({
        "group": back, "digest": F.lower(F.hex("digest")), "changed": F.lower(F.hex("changed"))}).withColumnRenamed("key", key)


def tampered(doc_id: Column) -> Column:
    """Documents whose text is checked without its line feeds: those with an even checksum of the id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0, F.lit(False))


def check(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Manifest of documents, held against documents whose line feeds may be lost.

    Columns as of :func:`manifest`. A null id is never tampered with, and a null text stays null.
    """
    columns = [F.col(c) for c in FIELDS]
    found = F.when(tampered(F.col("doc_id")), leaf([*columns[:-1], F.replace(columns[-1], F.lit("\n"), F.lit(""))]))
    return manifest(docs.select(*FIELDS), "doc_id", "source", leaf(columns), found, height)


def check_sql(rounds_of_leaves: int = 13, rounds_of_groups: int = 8) -> str:
    """The DuckDB statement for the query over ``documents`` with up to ``3 ** rounds`` leaves and groups."""
    text = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR END"
    fields = [text.format(c) for c in FIELDS]
    crc = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1),
        lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END))"""
    changed = text.format("replace(text, chr(10), '')")
    steps = [f"""
d AS (SELECT doc_id, source, sha256({' || '.join(fields)}) AS leaf,
    CASE WHEN ({crc}) % 2 = 1 THEN sha256({' || '.join([*fields[:-1], changed])}) END AS other FROM documents),
n0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, row_number() OVER () AS id FROM d),
t0 AS (SELECT source AS g, p, leaf AS h FROM n0),
v0 AS (SELECT id, source AS g, p, coalesce(other, leaf) AS f, '' AS proof FROM n0)"""]

    def level(i: int) -> str:
        return f"""
c{i} AS (SELECT g, p // 3 AS q, list(h ORDER BY p) AS run, sum(count(*)) OVER (PARTITION BY g) AS n FROM t{i} GROUP BY g, p // 3),
t{i + 1} AS (SELECT g, q AS p, CASE WHEN n = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS h FROM c{i}),
v{i + 1} AS (SELECT id, c.g, q AS p,
    CASE WHEN n = 1 THEN f ELSE sha256(array_to_string(run[:p % 3], '') || f || array_to_string(run[p % 3 + 2:], '')) END AS f,
    CASE WHEN n = 1 THEN proof ELSE proof || array_to_string(run[:p % 3], '') || array_to_string(run[p % 3 + 2:], '') END AS proof
    FROM v{i} v JOIN c{i} c ON v.g IS NOT DISTINCT FROM c.g AND v.p // 3 = c.q)"""

    steps += [level(i) for i in range(rounds_of_leaves)]
    a, b = rounds_of_leaves, rounds_of_leaves + rounds_of_groups + 1
    steps.append(f"""
s AS (SELECT g AS source, h AS subroot, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS place FROM t{a}),
t{a + 1} AS (SELECT 0 AS g, place AS p, subroot AS h FROM s),
v{a + 1} AS (SELECT id, 0 AS g, place AS p, f, proof FROM v{a} JOIN s ON g IS NOT DISTINCT FROM source)""")
    steps += [level(i) for i in range(a + 1, b)]
    return f"""WITH {",".join(steps)}
SELECT doc_id, leaf, subroot, t{b}.h AS root, sha256(proof) AS proof_sha256, f AS folded_root, f = t{b}.h AS verified
FROM v{b} JOIN n0 USING (id) JOIN s ON n0.source IS NOT DISTINCT FROM s.source, t{b}"""
