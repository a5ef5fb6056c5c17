"""Removal of byte strings that an earlier document also holds, by a distributed sort of suffixes.

A string of ``length`` bytes is found through anchors: positions whose hash of the next ``ANCHOR`` bytes is the
least among the positions that a string could begin it from. Equal strings have equal anchors at equal
offsets, so only suffixes that begin at an anchor are sorted, and of these only those whose anchor
also stands in another document. Splitters sampled from these suffixes part them by all bytes of their
anchor; each bucket is sorted word by word (multikey quicksort), to the right and to the left of the
anchor, and neighbours in both orders say which strings are equal. Equal strings share the bytes of their
anchor, so none of them lie on two sides of a splitter; suffixes with equal surroundings leave a bucket of
documents once, with their least owner, so an anchor that most documents hold brings few rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from brightloom.llm.common import forget, pieces, release_shuffles, small_batches, written

LENGTH, ANCHOR = 50, 20
OFFSETS = LENGTH - ANCHOR + 1  # places of an anchor in a string: 31, one bit each
LEFT = OFFSETS - 1
CONTEXT = LEFT + LENGTH
#: Bytes of text for each bucket, and anchors that a task holds before it hands them on.
BUCKET_BYTES, FLUSH = 6_000_000, 200_000
#: Bytes or suffixes that are worked on at a time.
PIECE = 200_000
_LAST = (1 << 63) - 1
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
COPY, PLACE, MASK, SUFFIX = range(4)
_ROW = "kind int, bucket long, origin long, a binary, b binary, c binary, d binary, e binary"
_COLUMNS = ["kind", "bucket", "origin", "a", "b", "c", "d", "e"]


def _windows(buffer: np.ndarray, dtype: str) -> np.ndarray:
    """The number that begins at each byte."""
    size = np.dtype(dtype).itemsize
    return np.ndarray(len(buffer) - size + 1, dtype, buffer, strides=(1,)).astype(np.uint64)


def _spread(values: np.ndarray, pick, width: int) -> np.ndarray:
    """``pick`` (least or largest) over each run of ``width`` neighbours."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and position of every anchor of the texts."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    if not len(sizes) or sizes.max() < LENGTH:
        return none
    buffer = np.frombuffer(b"".join(texts), np.uint8)
    words, tail = _windows(buffer, "<u8"), _windows(buffer, "<u4")
    n = len(buffer) - ANCHOR + 1
    h = (words[:n] * _A) ^ ((words[8:n + 8] * _B) >> np.uint64(3)) ^ (tail[16:n + 16] * _C)
    h = (h ^ (h >> np.uint64(32))) * _B
    h ^= h >> np.uint64(29)
    least = _spread(h, np.minimum, OFFSETS)  # by the begin of the string
    inside = np.zeros(len(buffer) + 1, dtype=np.int32)
    whole = sizes >= LENGTH
    np.add.at(inside, (ends - sizes)[whole], 1)
    np.add.at(inside, (ends - LENGTH + 1)[whole], -1)
    least[np.cumsum(inside)[:len(least)] == 0] = 0  # strings over the seam of two texts
    padded = np.concatenate([np.zeros(LEFT, np.uint64), least, np.zeros(LEFT, np.uint64)])
    at = np.flatnonzero((_spread(padded, np.maximum, OFFSETS) == h) & (h != 0))
    text = np.searchsorted(ends, at, side="right")
    return h[at], text, at - (ends - sizes)[text]


def multikey_order(words: np.ndarray) -> np.ndarray:
    """Order of the rows by their words from left to right; each pass only sorts rows that still tie."""
    order = np.argsort(words[:, 0], kind="stable")
    run = np.cumsum(np.r_[0, words[order[1:], 0] != words[order[:-1], 0]]) if len(order) else order
    for k in range(1, words.shape[1]):
        same = np.zeros(len(order) + 1, dtype=bool)
        same[1:-1] = run[1:] == run[:-1]
        tied = np.flatnonzero(same[1:] | same[:-1])
        if not len(tied):
            break
        rows = order[tied]
        order[tied] = rows[np.lexsort((words[rows, k], run[tied]))]
        split = np.r_[0, (run[1:] != run[:-1]) | (words[order[1:], k] != words[order[:-1], k])]
        run = np.cumsum(split)
    return order


def _words(matrix: np.ndarray) -> np.ndarray:
    """Rows of bytes as rows of big-endian numbers."""
    wide = -(-matrix.shape[1] // 8) * 8
    padded = np.zeros((len(matrix), wide), np.uint8)
    padded[:, :matrix.shape[1]] = matrix
    return padded.view(">u8").astype(np.uint64)


def _common(matrix: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row, in ``order``, with the one before; -1 for the first."""
    out = np.full(len(order), -1)
    for a in range(1, len(order), 50_000):
        now = order[a:a + 50_000]
        same = matrix[now] == matrix[order[a - 1:a - 1 + len(now)]]
        out[a:a + len(now)] = np.where(same.all(1), matrix.shape[1], same.argmin(1))
    return out


def first_holders(context: np.ndarray, before: np.ndarray, after: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bit ``o`` of a row: the string that begins ``o`` bytes before its anchor also has a holder of smaller ``order``.

    ``context`` holds ``LEFT`` bytes before and ``LENGTH`` bytes from the anchor on, of which ``before``
    and ``after`` lie in the text.
    """
    n = len(context)
    right, left = context[:, LEFT:], context[:, :LEFT][:, ::-1]
    by_right, by_left = multikey_order(_words(right)), multikey_order(_words(left))
    common_right, common_left = _common(right, by_right), _common(left, by_left)
    masks = np.zeros(n, np.uint32)
    group_right, group_left = np.empty(n, np.int64), np.empty(n, np.int64)
    for o in range(OFFSETS):
        group_right[by_right] = np.cumsum(common_right < LENGTH - o)
        group_left[by_left] = np.cumsum(common_left < o)
        held = np.flatnonzero((before >= o) & (after >= LENGTH - o))
        if not len(held):
            continue
        key = group_right[held] * (n + 1) + group_left[held]
        place = np.argsort(key, kind="stable")
        begin = np.flatnonzero(np.r_[True, key[place[1:]] != key[place[:-1]]])
        least = np.minimum.reduceat(order[held][place], begin)
        late = order[held][place] > np.repeat(least, np.diff(np.r_[begin, len(place)]))
        masks[held[place[late]]] |= np.uint32(1 << o)
    return masks


def removed(size: int, places: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Which bytes of a text lie in a marked string."""
    edge = np.zeros(size + 1, np.int64)
    item, bit = np.nonzero((masks[:, None] >> np.arange(OFFSETS, dtype=np.uint32)) & np.uint32(1))
    begin = places[item] - bit
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + LENGTH, -1)
    return np.cumsum(edge)[:size] > 0


def _cut(kind: int, target: np.ndarray, origin: int, *arrays: np.ndarray) -> Iterator[tuple]:
    """Rows that carry the items of each target bucket as packed arrays."""
    place = np.argsort(target, kind="stable")
    target = target[place]
    begin = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else []
    for a, b in zip(begin, np.r_[begin[1:], len(target)] if len(target) else []):
        packed = [x[place[a:b]].tobytes() for x in arrays]
        yield (kind, int(target[a]), origin, *packed, *[None] * (5 - len(packed)))


def _unpack(frame: pd.DataFrame, *dtypes: str) -> list[np.ndarray]:
    return [np.frombuffer(b"".join(frame[c]), t) for c, t in zip("abcde", dtypes)]


def _prime(least: int) -> int:
    n = max(2, least)
    while any(n % k == 0 for k in range(2, int(n**0.5) + 1)):
        n += 1
    return n


def dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept``.

    A byte is removed if it lies in a string of 50 bytes that also begins in a document of smaller
    ``doc_id``; ``kept`` is what is left (binary). A null text is empty. Rows of one id leave each
    other alone. Rows without id, or with one that is no whole number, come out without id and after all others,
    in an order fixed by their texts. An empty
    table gives an empty one. Copies of a whole text are removed by their digest.
    """
    spark = docs.sparkSession
    small_batches(spark)
    order = F.coalesce(F.col(doc_id).try_cast("long"), F.lit(_LAST) - F.pmod(F.xxhash64("text"), F.lit(1 << 20)))
    rows = docs.select(F.col(doc_id).try_cast("long").alias(doc_id), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select(F.col(doc_id).alias("doc_id"), "text", order.alias("order"), F.xxhash64("text").alias("tag"))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n"), F.count("*").alias("rows")).first()
    buckets = _prime(total["n"] // BUCKET_BYTES + 1)
    rows = rows.withColumn("bucket", F.pmod("order", F.lit(buckets)))
    long_ = rows.filter(F.octet_length("text") >= LENGTH)

    digests = long_.select("order", "tag", "bucket", F.md5("text").alias("digest"))
    firsts = written(digests.groupBy("digest").agg(F.min("order").alias("_first")), "firsts")
    late = digests.join(firsts, "digest").filter(F.col("order") > F.col("_first"))
    copies = written(late.groupBy("bucket").agg(F.collect_list(F.struct("order", "tag")).alias("items")).select(
        F.lit(COPY).alias("kind"), "bucket", F.lit(0).cast("long").alias("origin"), "items"), "copies")

    found = written(long_.select("order", "text").mapInPandas(_anchor_rows(buckets), _ROW).groupBy("bucket").applyInPandas(_shared(buckets), _ROW), "places")
    release_shuffles(spark)
    splitters = _splitters(long_, found, total["rows"], buckets)
    packed = "cast(null as array<struct<order:long,tag:long>>) AS items"
    copy_rows = copies.selectExpr("kind", "bucket", "origin", *[f"cast(null as binary) AS {c}" for c in "abcde"], "items")
    known = found.selectExpr("*", packed).unionByName(copy_rows)
    suffixes = written(
        long_.select("bucket", "order", "tag", "text").groupBy("bucket").cogroup(known.groupBy("bucket")).applyInPandas(_suffixes(splitters), _ROW), "suffixes", "zstd")
    met = written(suffixes.filter(F.col("kind") == MASK), "met")
    forget(found)
    del known, found
    release_shuffles(spark)
    masks = written(suffixes.filter(F.col("kind") == SUFFIX).groupBy("bucket").applyInPandas(_compared, _ROW), "masks")
    forget(suffixes)
    del suffixes
    release_shuffles(spark)
    marks = masks.unionByName(met).selectExpr("*", packed).unionByName(copy_rows)
    out = rows.select("bucket", "doc_id", "order", "tag", "text").groupBy("bucket").cogroup(marks.groupBy("bucket")).applyInPandas(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    return out


def _anchor_rows(buckets: int):
    """Anchors of each task's texts by their hash; equal texts at hand are taken once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0

        def flush() -> pd.DataFrame:
            h, order, place = (np.concatenate(x) for x in zip(*held))
            # Anchors are least hashes, so their values crowd at the low end; mixed again they are even.
            mixed = (h * _C) >> np.uint64(32)
            target = (mixed * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            return pd.DataFrame(list(_cut(PLACE, target, 0, h, order, place)), columns=_COLUMNS)

        for batch in batches:
            batch = batch.sort_values("order", kind="stable").drop_duplicates("text")
            texts, orders = batch["text"].tolist(), batch["order"].to_numpy(np.int64)
            for part in pieces(texts, PIECE):
                h, text, place = anchors([t.encode("utf-8", "replace") for t in texts[part]])
                held.append((h, orders[part][text], place.astype(np.uint32)))
                size += len(h)
                if size > FLUSH:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    return run


def _shared(buckets: int):
    """Of the anchors of one share of hashes, those that stand in several documents, by their documents' bucket."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        h, order, place = _unpack(frame, "<u8", "<i8", "<u4")
        by = np.argsort(h, kind="stable")
        h, order, place = h[by], order[by], place[by]
        begin = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
        many = np.minimum.reduceat(order, begin) != np.maximum.reduceat(order, begin)
        use = np.repeat(many, np.diff(np.r_[begin, len(h)]))
        return pd.DataFrame(list(_cut(PLACE, order[use] % buckets, 0, order[use], place[use])), columns=_COLUMNS)

    return run


def _splitters(rows: DataFrame, found: DataFrame, n: int, buckets: int, docs: int = 2000, each: int = 50, some: int = 32) -> np.ndarray:
    """Anchors that part the suffixes to be sorted evenly, from about ``docs`` texts of ``some`` buckets and ``each`` suffixes of a text."""
    sampled = sorted({i * buckets // some for i in range(some)})
    share = int(min(1.0, docs * buckets / max(1, n * len(sampled))) * (1 << 20))

    def leads(frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        order, place = _unpack(known, "<i8", "<u4")
        by = np.argsort(order, kind="stable")
        order, place = order[by], place[by]
        out: list[bytes] = []
        for own, t in zip(frame["order"], frame["text"]):
            t = t.encode("utf-8", "replace")
            at = place[np.searchsorted(order, own, side="left"):np.searchsorted(order, own, side="right")]
            out += [t[p:p + ANCHOR] for p in at[::max(1, len(at) // each)][:each]]
        return pd.DataFrame({"lead": out})

    drawn = rows.filter(F.col("bucket").isin(sampled) & (F.pmod(F.xxhash64("order", "tag"), F.lit(1 << 20)) < share)).select("bucket", "order", "text")
    pairs = drawn.groupBy("bucket").cogroup(found.filter(F.col("bucket").isin(sampled)).groupBy("bucket"))
    leads_ = np.sort(np.array([bytes(r["lead"]) for r in pairs.applyInPandas(leads, "lead binary").collect()], dtype=f"S{ANCHOR}"))
    return np.unique(leads_[np.linspace(0, len(leads_) - 1, buckets + 1).astype(int)[1:-1]]) if len(leads_) else leads_


def _ordered(frame: pd.DataFrame) -> pd.DataFrame:
    """Rows of a bucket in an order that is the same each time."""
    return frame.sort_values(["order", "tag"], kind="stable").reset_index(drop=True)


def _is_copy(frame: pd.DataFrame, known: pd.DataFrame) -> np.ndarray:
    late = {(i["order"], i["tag"]) for items in known.loc[known["kind"] == COPY, "items"] for i in items}
    return np.array([pair in late for pair in zip(frame["order"].tolist(), frame["tag"].tolist())], dtype=bool)


def _suffixes(splitters: np.ndarray):
    """Suffixes with a partner, by range of their leading bytes; those met in this bucket already are marked at once."""

    def run(key, frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        bucket, rows = int(key[0]), []
        frame = _ordered(frame)
        order, place = _unpack(known[known["kind"] == PLACE], "<i8", "<u4")
        if len(frame) and len(order):
            texts = [t.encode("utf-8", "replace") for t in frame["text"]]
            sizes = np.array([len(t) for t in texts])
            first = np.r_[0, np.cumsum(sizes + CONTEXT)][:-1] + LEFT
            gap = bytes(CONTEXT)
            buffer = np.frombuffer(bytes(LEFT) + gap.join(texts) + gap, np.uint8)
            live = np.flatnonzero(~_is_copy(frame, known))
            by = np.argsort(order, kind="stable")
            order, place = order[by], place[by].astype(np.int64)
            own = frame["order"].to_numpy(np.int64)[live]
            begin, end = np.searchsorted(order, own, side="left"), np.searchsorted(order, own, side="right")
            row = np.repeat(live, end - begin)
            place = place[np.concatenate([np.arange(a, b) for a, b in zip(begin, end)]).astype(np.int64)] if len(live) else place[:0]
            fits = place < sizes[row]
            row, place = row[fits], place[fits]
            owner = frame["order"].to_numpy(np.int64)[row]
            for a in range(0, len(row), PIECE):
                part = slice(a, a + PIECE)
                rows += _suffix_rows(buffer, first, sizes, row[part], place[part], owner[part], splitters, bucket)
        return pd.DataFrame(rows, columns=_COLUMNS)

    return run


def _suffix_rows(buffer, first, sizes, row, place, owner, splitters, bucket: int) -> Iterator[tuple]:
    context = np.lib.stride_tricks.sliding_window_view(buffer, CONTEXT)[first[row] + place - LEFT]
    before, after = np.minimum(place, LEFT), np.minimum(sizes[row] - place, LENGTH)
    full = np.concatenate([context, before[:, None].astype(np.uint8), after[:, None].astype(np.uint8)], axis=1)
    _, which = np.unique(np.ascontiguousarray(full).view(f"V{full.shape[1]}").ravel(), return_inverse=True)
    least = np.full(which.max() + 1, _LAST)
    np.minimum.at(least, which, owner)
    late = owner > least[which]
    offsets = np.arange(OFFSETS)
    fits = (before[:, None] >= offsets) & (after[:, None] >= LENGTH - offsets)
    masks = (fits.astype(np.uint32) << offsets.astype(np.uint32)).sum(1, dtype=np.uint32)
    row, place = row.astype(np.uint32), place.astype(np.uint32)
    yield from _cut(MASK, np.full(int(late.sum()), bucket), bucket, row[late], place[late], masks[late])
    lead = np.ascontiguousarray(context[:, LEFT:LEFT + ANCHOR]).view(f"S{ANCHOR}").ravel()
    send = ~late
    yield from _cut(SUFFIX, np.searchsorted(splitters, lead[send], side="right"), bucket, full[send], owner[send], row[send], place[send])


def _compared(frame: pd.DataFrame) -> pd.DataFrame:
    """Sort the suffixes of one range and mark the strings that an earlier document holds too."""
    full, order, row, place = _unpack(frame, "u1", "<i8", "<u4", "<u4")
    full = full.reshape(-1, CONTEXT + 2)
    origin = np.repeat(frame["origin"].to_numpy(np.int64), [len(x) // 8 for x in frame["b"]])
    masks = first_holders(full[:, :CONTEXT], full[:, CONTEXT].astype(np.int64), full[:, CONTEXT + 1].astype(np.int64), order)
    use = masks != 0
    return pd.DataFrame(list(_cut(MASK, origin[use], 0, row[use], place[use], masks[use])), columns=_COLUMNS)


def _kept(key, frame: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    frame = _ordered(frame)
    copy = _is_copy(frame, known)
    row, place, masks = _unpack(known[known["kind"] == MASK], "<u4", "<u4", "<u4")
    # Texts too short to hold a string are no rows of the sorts before; they stand in the same order.
    long_ = np.array([len(t.encode("utf-8", "replace")) >= LENGTH for t in frame["text"]], dtype=bool)
    number = np.cumsum(long_) - 1
    by = np.argsort(row, kind="stable")
    row, place, masks = row[by], place[by].astype(np.int64), masks[by]
    out = []
    for i, (doc_id, text) in enumerate(zip(frame["doc_id"].astype("Int64"), frame["text"])):
        text = text.encode("utf-8", "replace")
        a, b = np.searchsorted(row, [number[i], number[i] + 1]) if long_[i] else (0, 0)
        if copy[i]:
            gone = np.ones(len(text), dtype=bool)
        else:
            gone = removed(len(text), place[a:b], masks[a:b])
        rest = np.frombuffer(text, np.uint8)[~gone].tobytes()
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out.append((None if doc_id is pd.NA else int(doc_id), len(text), int(gone.sum()), spans, hashlib.sha256(rest).hexdigest(), rest))
    frame = pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])
    return frame.astype({"doc_id": "Int64"})
