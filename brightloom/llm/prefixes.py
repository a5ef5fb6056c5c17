"""Prefix trie of conversations: a skeleton of splitter paths, finished by sorted shards.

A turn is a token of fixed width (digest and number of code points), a conversation the path of its tokens, cut
into segments so that no row grows with a conversation. Rows are range-partitioned and sorted by path. The paths
at which the shards begin form the skeleton, which every task gets. A node off the skeleton has all its
members in one shard, which finishes it while it walks its rows with a stack as deep as a segment. A skeleton
node gets a partial aggregate from each shard it reaches into; these are reduced by node and then summed up
along the skeleton, which has at most a segment of nodes for each partition.

Segments after the first begin at an anchor, the digest of all turns before. What lies below an anchor is
summed over anchors by doubling and enters the walk over the segments above.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Mapping, Sequence
from hashlib import sha256
from os.path import commonprefix
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.llm.common import written
from brightloom.operators.positions import range_sorted, with_group_position
from brightloom.operators.skew import salted_join

#: Characters of a token: base64 of 16 bytes of digest and 5 bytes of length.
TOKEN = 28
#: Turns of a segment.
SEGMENT = 512
#: Conversation ids in a row of a list that several shards contribute to.
LIST = 500
#: Turns that a conversation may take over from the first of its hundred.
SHARED, HUNDRED = 6, 100


def token(role: Column, text: Column) -> Column:
    """A turn as text of fixed width; nulls count as empty."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.base64(F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.length(text)), 10, "0"))))


def code_points(turn: str) -> int:
    return int.from_bytes(base64.b64decode(turn)[16:], "big")


def _tokens(path: Column, begin: Column, count: Column | None = None) -> Column:
    """``count`` tokens of a path from number ``begin`` on, or all."""
    start = (begin * TOKEN + 1).cast("int")
    return F.substring(path, start, F.lit(1 << 30) if count is None else (count * TOKEN).cast("int"))


def _joined(rows: DataFrame, order: str, path: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct(order, path)))
    return rows.groupBy("conv_id", "segment").agg(F.array_join(F.transform(ordered, lambda x: x[path]), "").alias("path"))


def rebuilt(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """Segments ``conv_id, segment, path`` of the rebuilt conversations, at least one for each id.

    Conversation ``c`` takes its first ``crc32(c) % 6`` turns from conversation ``c - c % 100``, as far as that has
    them, and goes on with its own turns after as many. Turns are ordered by ``turn``, null first, and alike numbers
    by token; rows without an id are left out.
    """
    turns = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", token(F.col("role"), F.col("text")).alias("token"))
    placed = with_group_position(turns, ["conv_id"], [F.col("turn").asc_nulls_first(), "token"], "place")
    own = _joined(placed.withColumn("segment", F.floor(F.col("place") / segment).cast("long")), "place", "token")
    own = written(own, "turns").withColumn("_taken", F.crc32(F.col("conv_id").cast("string").cast("binary")) % SHARED)
    first = F.col("conv_id") - F.col("conv_id") % HUNDRED
    heads = own.filter((F.col("segment") == 0) & (F.col("conv_id") == first)).select(
        F.col("conv_id").alias("_first"), _tokens(F.col("path"), F.lit(0), F.lit(SHARED)).alias("_head"))
    # A hundred conversations share a head, and a long one brings a row for each segment.
    row = own.join(heads, first == F.col("_first"), "left")
    if segment < SHARED:
        raise ValueError("the turns taken over must fit a segment")
    head = _tokens(F.coalesce("_head", F.lit("")), F.lit(0), F.col("_taken"))
    row = row.withColumn("_head", head).withColumn("_lost", F.col("_taken") - F.length("_head") / TOKEN)
    whole = F.when(F.col("segment") == 0, F.concat("_head", _tokens(F.col("path"), F.col("_taken")))).otherwise(F.col("path"))
    start = F.when(F.col("segment") == 0, F.lit(0)).otherwise(F.col("segment") * segment - F.col("_lost")).cast("long")
    row = row.select("conv_id", whole.alias("_whole"), start.alias("_start"))
    number, room = F.floor(F.col("_start") / segment).cast("long"), segment - F.col("_start") % segment
    rest = _tokens(F.col("_whole"), room)
    pieces = F.array(
        F.struct(number.alias("segment"), F.col("_start").alias("start"), _tokens(F.col("_whole"), F.lit(0), room).alias("piece")),
        F.struct((number + 1).alias("segment"), (F.col("_start") + room).alias("start"), rest.alias("piece")))
    cut = row.select("conv_id", F.explode(F.filter(pieces, lambda p: (p.piece != "") | (p.start == 0))).alias("p"))
    return _joined(cut.select("conv_id", "p.*"), "start", "piece")


def _chained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Anchor of every segment, and of the next one where the conversation has one; rows in order."""
    held: tuple | None = None  # conv_id, segment, anchor, anchor of what follows
    for batch in batches:
        rows = []
        for conv_id, segment, digest in batch[["conv_id", "segment", "digest"]].itertuples(index=False):
            goes_on = held is not None and held[0] == conv_id
            if held:
                rows.append((*held[:3], held[3] if goes_on else None))
            anchor = held[3] if goes_on else ""
            held = (conv_id, segment, anchor, sha256((anchor + digest).encode()).hexdigest())
        yield pd.DataFrame(rows, columns=["conv_id", "segment", "anchor", "next"])
    if held:
        yield pd.DataFrame([(*held[:3], None)], columns=["conv_id", "segment", "anchor", "next"])


def anchored(segments: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """``segments`` with ``anchor``, empty for the first of a conversation, and ``next``, null for its last.

    Only segments of conversations that may have more than one are chained, by their digests.
    """
    chain = segments.filter((F.length("path") == segment * TOKEN) | (F.col("segment") > 0))
    chain = chain.select("conv_id", "segment", F.sha2(F.col("path").cast("binary"), 256).alias("digest"))
    chain = chain.repartition("conv_id").sortWithinPartitions("conv_id", "segment")
    chain = chain.mapInPandas(_chained, "conv_id long, segment long, anchor string, next string")
    found = segments.join(chain, ["conv_id", "segment"], "left")
    return found.withColumn("anchor", F.coalesce("anchor", F.lit("")))


class Splitter(NamedTuple):
    """The row at which a shard begins."""

    segment: int
    anchor: str
    path: str


class _Open:
    """A node on the stack of a walk; what it has seen of its subtree so far."""

    __slots__ = ("skeleton", "members", "least", "children", "leaves", "saved", "ends", "ids", "chunk", "held", "next", "below")

    def __init__(self, skeleton: bool):
        self.skeleton = skeleton
        self.members = self.children = self.leaves = self.saved = self.chunk = 0
        self.least: int | None = None
        self.ends = None
        self.ids: list[str] = []
        self.held: list[list] = []
        self.next: str | None = None
        self.below = (0, 0, 0)


def finished(members: int, length: int, children: int, leaves: int, saved: int, goes_on: bool, below: Sequence[int]) -> tuple[int, int, int]:
    """Children, leaves and saved code points of a node, from the sums over its children and what lies below its anchor."""
    children += below[0]
    leaves = leaves + below[1] if children or goes_on else 1
    return children, leaves, saved + below[2] + (members - 1) * length


_WALK = (
    "kind string, key string, shard int, chunk long, segment long, anchor string, prefix string, next string, conv_id long, depth long, "
    "parent_conv_id long, parent_key string, parent_anchor string, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends string, below_children long, below_leaves long, below_saved long")
_FIELDS = [c.split()[0] for c in _WALK.split(", ")]
_AT = {c: i for i, c in enumerate(_FIELDS)}
_ROW = ["segment", "anchor", "path", "conv_id", "next", "below_children", "below_leaves", "below_saved"]


def node_key(segment: int, anchor: str, prefix: str) -> str:
    return sha256(f"{segment}:{anchor}:{prefix}".encode()).hexdigest()


def _shared(a: str, b: str) -> int:
    """Tokens that two paths begin with."""
    return len(commonprefix((a, b))) // TOKEN


class _Walk:
    """One sorted shard: rows come in, nodes and partial aggregates go to ``out``."""

    def __init__(self, shard: int, splitters: Sequence[Splitter], segment: int):
        self.shard, self.splitters, self.size = shard, splitters, segment
        self.out: list[list] = []
        self.group: tuple[int, str] | None = None
        self.path = ""
        self.stack: list[_Open] = []

    def emit(self, **values) -> None:
        self.out.append([values.get(c) for c in _FIELDS])

    def add(self, segment: int, anchor: str, path: str, conv_id: int, following: str | None, below: Sequence[int]) -> None:
        if (segment, anchor) != self.group:
            self.close(-1)
            self.group, self.path, common = (segment, anchor), path, -1
        else:
            common = _shared(path, self.path)
            self.close(common)
            self.path = path
        deep = len(path) // TOKEN
        if common < deep:
            on = max((_shared(path, s.path) for s in self.splitters if s[:2] == self.group), default=-1)
            self.stack += [_Open(d <= on) for d in range(common + 1, deep + 1)]
        top = self.stack[-1]
        top.members += 1
        top.least = conv_id if top.least is None else min(top.least, conv_id)
        if following is not None:
            top.next, top.below = following, tuple(int(x) for x in below)
        elif top.skeleton:
            top.ids.append(str(conv_id))
            if len(top.ids) == LIST:
                self.list_out(deep, top)
        elif top.ends is None:
            top.ends = sha256(str(conv_id).encode())
        else:
            top.ends.update(f",{conv_id}".encode())

    def prefix(self, depth: int) -> str:
        return self.path[:depth * TOKEN]

    def list_out(self, depth: int, node: _Open) -> None:
        self.emit(kind="list", key=node_key(*self.group, self.prefix(depth)), shard=self.shard, chunk=node.chunk, ends=",".join(node.ids))
        node.chunk += 1
        node.ids = []

    def close(self, upto: int) -> None:
        """Close the nodes below depth ``upto`` of the current path."""
        while len(self.stack) - 1 > upto:
            node, depth = self.stack.pop(), len(self.stack)
            parent = self.stack[-1] if self.stack else None
            if parent:
                parent.members += node.members
                parent.least = node.least if parent.least is None else min(parent.least, node.least)
            if node.skeleton:
                self.partial(node, depth)
            else:
                self.finish(node, depth, parent)

    def partial(self, node: _Open, depth: int) -> None:
        segment, anchor = self.group
        if node.ids:
            self.list_out(depth, node)
        self.emit(
            kind="partial", key=node_key(segment, anchor, self.prefix(depth)), segment=segment, anchor=anchor, prefix=self.prefix(depth),
            next=node.next, conv_id=node.least, n_convs=node.members, n_children=node.children, n_leaves=node.leaves,
            saved_tokens=node.saved, below_children=node.below[0], below_leaves=node.below[1], below_saved=node.below[2])

    def finish(self, node: _Open, depth: int, parent: _Open | None) -> None:
        segment, anchor = self.group
        length = code_points(self.path[(depth - 1) * TOKEN:depth * TOKEN]) if depth else 0
        children, leaves, saved = finished(node.members, length, node.children, node.leaves, node.saved, node.next is not None, node.below)
        for row in node.held:
            row[_AT["parent_conv_id"]] = node.least
        self.out += node.held
        if depth == 0 and segment > 0:
            return self.emit(kind="top", anchor=anchor, n_children=children, n_leaves=leaves, saved_tokens=saved)
        self.emit(
            kind="node", next=node.next, conv_id=node.least, depth=segment * self.size + depth, n_convs=node.members, n_children=children,
            n_leaves=leaves, saved_tokens=saved, ends=(node.ends or sha256()).hexdigest())
        if parent is None:
            return None
        row = self.out[-1]
        if depth == 1 and segment > 0:
            row[_AT["parent_anchor"]] = anchor
        elif parent.skeleton:
            row[_AT["parent_key"]] = node_key(segment, anchor, self.prefix(depth - 1))
        else:
            parent.held.append(self.out.pop())
        parent.children += 1
        parent.leaves += leaves
        parent.saved += saved
        return None


def _walked(splitters: Mapping[int, Sequence[Splitter]], segment: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        walk = None
        for batch in batches:
            if not len(batch):
                continue
            shard = int(batch["_part"].iloc[0])
            walk = walk or _Walk(shard, splitters[shard], segment)
            for s, anchor, path, conv_id, following, *below in batch[_ROW].itertuples(index=False, name=None):
                walk.add(int(s), anchor, path, int(conv_id), following, below)
            yield pd.DataFrame(walk.out, columns=_FIELDS, dtype=object)
            walk.out = []
        if walk:
            walk.close(-1)
            yield pd.DataFrame(walk.out, columns=_FIELDS, dtype=object)

    return run


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Hash of the lists of each key; the rows of a key come in order and are read one after the other."""
    key, ends = None, None
    for batch in batches:
        rows = []
        for own, ids in batch[["key", "ends"]].itertuples(index=False):
            if own == key:
                ends.update(f",{ids}".encode())
            else:
                if key is not None:
                    rows.append((key, ends.hexdigest()))
                key, ends = own, sha256(ids.encode())
        yield pd.DataFrame(rows, columns=["key", "ends"])
    if key is not None:
        yield pd.DataFrame([(key, ends.hexdigest())], columns=["key", "ends"])


def _skeleton(walked: DataFrame, segment: int) -> DataFrame:
    """The finished nodes of the skeleton, from one reduced row for each; rows as of the walk."""
    partial = walked.filter("kind = 'partial'").groupBy("key", "segment", "anchor", "prefix").agg(
        F.max("next").alias("next"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        *[F.max(c).alias(c) for c in ("below_children", "below_leaves", "below_saved")])
    lists = walked.filter("kind = 'list'").select("key", "shard", "chunk", "ends")
    lists = lists.repartition("key").sortWithinPartitions("key", "shard", "chunk").mapInPandas(_hashed, "key string, ends string")
    ends = {r["key"]: r["ends"] for r in lists.collect()}  # skeleton nodes only
    nodes = {(r["segment"], r["anchor"], r["prefix"]): r.asDict() for r in partial.collect()}  # a path for each partition
    rows = []
    for at in sorted(nodes, key=lambda at: -len(at[2])):
        node, (number, anchor, prefix) = nodes[at], at
        depth, below = len(prefix) // TOKEN, [node[c] for c in ("below_children", "below_leaves", "below_saved")]
        length = code_points(prefix[-TOKEN:]) if depth else 0
        children, leaves, saved = finished(
            node["n_convs"], length, node["n_children"], node["n_leaves"], node["saved_tokens"], node["next"] is not None, below)
        done = {"n_children": children, "n_leaves": leaves, "saved_tokens": saved}
        if depth == 0 and number > 0:
            rows.append(done | {"kind": "top", "anchor": anchor})
            continue
        done |= {"kind": "node", "key": node["key"], "next": node["next"], "conv_id": node["conv_id"], "n_convs": node["n_convs"],
                 "depth": number * segment + depth, "ends": ends.get(node["key"], sha256().hexdigest())}
        if depth:
            parent = nodes[number, anchor, prefix[:-TOKEN]]
            parent["n_children"] += 1
            parent["n_leaves"] += leaves
            parent["saved_tokens"] += saved
            done |= {"parent_anchor": anchor} if depth == 1 and number > 0 else {"parent_conv_id": parent["conv_id"]}
        rows.append(done)
    spark = walked.sparkSession
    return spark.createDataFrame([tuple(r.get(c) for c in _FIELDS) for r in rows], _WALK)


def _finished(rows: DataFrame, segment: int) -> tuple[DataFrame, DataFrame]:
    """Sort the segments, walk the shards, and finish the skeleton: rows of both."""
    ranged = range_sorted(rows, ["segment", "anchor", "path", "conv_id"])
    starts = sorted(ranged.filter("_index = 0").select("_part", "segment", "anchor", "path").collect())  # one a partition
    begins = [Splitter(*r[1:]) for r in starts]
    around = {r[0]: [*begins[max(i, 1):i + 1], *begins[i + 1:i + 2]] for i, r in enumerate(starts)}
    walked = written(ranged.mapInPandas(_walked(around, segment), _WALK), "walked")
    return walked, _skeleton(walked, segment)


def _below(rows: DataFrame, walked: DataFrame, skeleton: DataFrame) -> DataFrame:
    """``rows`` with what lies below the anchor at their end: direct children, leaves and savings of the whole subtree."""
    tops = walked.unionByName(skeleton).filter("kind = 'top'")
    sums = written(tops.select("anchor", "n_children", "n_leaves", "saved_tokens"), "tops")
    up = rows.filter("next IS NOT NULL").groupBy(F.col("next").alias("anchor")).agg(F.max("anchor").alias("up"))
    up = written(up.filter("up <> ''"), "up")
    while not up.isEmpty():  # twice as far each time
        more = sums.join(up, "anchor").groupBy("up").agg(F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved"))
        sums = written(sums.join(more.withColumnRenamed("up", "anchor"), "anchor", "left").select(
            "anchor", "n_children", (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens")), "tops")
        ahead = up.select(F.col("anchor").alias("up"), F.col("up").alias("_up"))
        up = written(up.join(ahead, "up").select("anchor", F.col("_up").alias("up")), "up")
    sums = sums.select(F.col("anchor").alias("next"), F.col("n_children").alias("below_children"),
                       F.col("n_leaves").alias("below_leaves"), F.col("saved_tokens").alias("below_saved"))
    plain = [c for c in rows.columns if not c.startswith("below_")]
    going = salted_join(rows.filter("next IS NOT NULL").select(plain), sums, ["next"], ["conv_id"])
    return rows.filter("next IS NULL").unionByName(going)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(conversations: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """One row for each node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Rows without ``conv_id`` are left out; a null turn comes first, a null role or text is empty; turns alike in
    number are ordered by token, rows alike in all fields are turns of their own; conversations alike in all turns
    end at one node, however many they are; an empty table gives no node, not even the root.
    """
    rows = written(anchored(written(rebuilt(conversations, segment), "segments"), segment), "anchored")
    rows = rows.select("*", *[F.lit(0).cast("long").alias(c) for c in _ROW[-3:]])
    deep = (rows.agg(F.max("segment")).first()[0] or 0) > 0
    walked, skeleton = _finished(rows, segment)
    if deep:
        walked, skeleton = _finished(written(_below(rows, walked, skeleton), "below"), segment)
    least = skeleton.filter("key IS NOT NULL").select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_least"))
    nodes = walked.filter("kind = 'node'").join(F.broadcast(least), "parent_key", "left")  # a path for each partition
    nodes = nodes.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_least")).drop("_least")
    nodes = nodes.unionByName(skeleton.filter("kind = 'node'"))
    if deep:
        anchors = nodes.filter("next IS NOT NULL").select(F.col("next").alias("parent_anchor"), F.col("conv_id").alias("_least"))
        below = salted_join(nodes.filter("parent_anchor IS NOT NULL"), anchors, ["parent_anchor"], ["conv_id", "depth"])
        below = below.withColumn("parent_conv_id", F.col("_least")).drop("_least")
        nodes = nodes.filter("parent_anchor IS NULL").unionByName(below)
    return nodes.withColumnRenamed("ends", "ends_sha256").select(*COLUMNS)


def check_sql() -> str:
    """The DuckDB statement for the query over ``conversations``."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1),
        lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)), 4294967295)"""
    return f"""
WITH c AS (SELECT conv_id, turn, {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS said FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(said ORDER BY turn NULLS FIRST, said) AS turns, ({crc}) % {SHARED} AS h FROM c GROUP BY conv_id),
re AS (SELECT o.conv_id, list_concat(coalesce(b.turns, [])[:o.h], o.turns[o.h + 1:]) AS turns
    FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % {HUNDRED}),
m AS (SELECT conv_id, turns, len(turns) AS n, unnest(range(len(turns) + 1)) AS depth FROM re),
nodes AS (SELECT depth, turns[:depth] AS path, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * coalesce(any_value(length(turns[depth].t)) FILTER (depth > 0), 0) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = depth), '')) AS ends_sha256 FROM m GROUP BY 1, 2),
up AS (SELECT depth - 1 AS depth, path[:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2),
whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN up USING (depth, path)),
over AS (SELECT unnest(range(depth + 1)) AS d, path, saved, n_children FROM whole),
subtree AS (SELECT d AS depth, path[:d] AS path, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM over GROUP BY 1, 2)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, s.n_leaves, s.saved_tokens, w.ends_sha256
FROM whole w JOIN subtree s ON w.depth = s.depth AND w.path = s.path
LEFT JOIN nodes p ON p.depth = w.depth - 1 AND p.path = w.path[:w.depth - 1]"""
