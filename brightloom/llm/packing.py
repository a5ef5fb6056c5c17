"""Best-fit packing of token sequences, planned on the histogram of lengths.

Patterns of few lengths that fill a sequence are enumerated on a coarse grid; a non-negative least-squares
fit says how often each is used; counts are rounded down and what is left is packed best-fit. The plan
only depends on how many pieces there are of each length, so it is small whatever the number of
documents: one row per run of equal sequences. Each piece then finds its place by its length and
its number among the pieces of that length.
"""

from __future__ import annotations

import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F
from tokenizers import Tokenizer

from brightloom.llm.common import pieces, written

CAPACITY = 4096
END_ID = 1
#: Parts whose ids a worker keeps in each of two stores, newer and older.
_MEMO = 200_000


# How the tokenizer file parts a word of lower-case Latin letters, and the bytes that it writes as other letters.
_LATIN, _NUMBERS = "a-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
PARTS = re.compile(rf"[{_LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d|[{_NUMBERS}]|[^\s{_LATIN}{_NUMBERS}]+")
_OWN_LETTER = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_LETTERS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _OWN_LETTER)}
#: Anything else than printable Latin letters and signs, which go to lower case one by one and never combine.
_OTHER = re.compile(r"[^\t\n\r\x20-\x7e\xa1-\xac\xae-\u024f]|<\|")


class _Parts(dict):
    """Ids of a part as bytes. When full, parts in use move on from the older store."""

    def __init__(self, model, older: dict[str, bytes]) -> None:
        self.model, self.older = model, older

    def __missing__(self, part: str) -> bytes:
        found = self.older.get(part)
        if found is None:
            letters = part if part.isascii() else part.encode().decode("latin-1").translate(BYTE_LETTERS)
            found = b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(letters)])
        self[part] = found
        return found


class Ids:
    """Token ids of texts.

    The tokenizer drops white space and merges letters only inside a part of a word, so the ids of a text
    are those of its parts in order, and a part met before need not be worked out again. Texts with
    other than plain Latin signs take the tokenizer word by word, for the words that need it.
    """

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.parts = _Parts(self.tokenizer.model, {})

    def _plain(self, text: str) -> bytes:
        return b"".join(map(self.parts.__getitem__, PARTS.findall(text.lower())))

    def _word(self, word: str) -> bytes:
        if _OTHER.search(word) is None:
            return self._plain(word)
        return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def __call__(self, text: str, end_id: int = END_ID) -> np.ndarray:
        if len(self.parts) > _MEMO:
            older, self.parts.older = self.parts, {}
            self.parts = _Parts(self.tokenizer.model, older)
        if _OTHER.search(text) is None:
            ids = self._plain(text)
        else:
            ids = b"".join(self._word(w.decode()) for w in text.encode("utf-8", "replace").split())
        return np.frombuffer(ids + end_id.to_bytes(4, "little"), dtype="<u4")


def patterns(slots: int, most: int = 4, limit: int = 3) -> np.ndarray:
    """All ways to fill ``slots`` grid steps with up to ``most`` lengths; rows count each length.

    Longer patterns than ``limit`` repeat one length: ``limit - 1`` lengths and as many of one as fit.
    """
    found = set()

    def fill(left: int, biggest: int, parts: tuple[int, ...]) -> None:
        if left == 0:
            found.add(parts)
        elif len(parts) + 1 == limit:
            if left <= biggest:
                found.add((*parts, left))
        else:
            for x in range(min(left, biggest), 0, -1):
                fill(left - x, x, (*parts, x))

    fill(slots, slots, ())
    for x in range(1, slots // most + 1):
        n, rest = divmod(slots, x)
        found.add((x,) * n + ((rest,) if rest else ()))
    ordered = sorted(found)
    out = np.zeros((len(ordered), slots + 1))
    for i, parts in enumerate(ordered):
        np.add.at(out[i], list(parts), 1.0)
    return out[:, 1:]


def nnls(a: np.ndarray, b: np.ndarray, most: int | None = None) -> np.ndarray:
    """Non-negative least squares by the active-set method: the ``x >= 0`` with least ``|ax - b|``."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], dtype=bool)
    scale = max(1.0, float(np.abs(b).max()))
    for _ in range(most or 3 * a.shape[0]):
        gain = a.T @ (b - a @ x)
        gain[active] = -np.inf
        best = int(gain.argmax())
        if gain[best] <= 1e-9 * scale:
            break
        active[best] = True
        while True:
            at = np.flatnonzero(active)
            trial = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (trial > 0).all():
                x[:] = 0
                x[at] = trial
                break
            down = trial <= 0
            step = (x[at[down]] / np.maximum(x[at[down]] - trial[down], 1e-300)).min()
            x[at] += step * (trial - x[at])
            gone = at[x[at] <= 1e-12]
            if not len(gone):
                gone = at[[int(x[at].argmin())]]
            x[gone] = 0
            active[gone] = False
            if best in gone and len(gone) == 1:
                break
        if not active[best]:
            break
    return x


def plan(histogram: dict[int, int], capacity: int = CAPACITY, grid: int = 128) -> list[tuple[tuple[int, ...], int]]:
    """Runs ``(lengths, repeats)``: so many sequences that hold these lengths, in this order.

    ``histogram`` counts the pieces of each length up to ``capacity``; every piece is used once.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    step = max(1, -(-capacity // grid))
    slots = -(-capacity // step)
    usable = slots if slots * step <= capacity else capacity // step
    by_step: dict[int, list[list[int]]] = defaultdict(list)
    for n in sorted(left):
        if n <= usable * step:
            by_step[-(-n // step)].append([n, left[n]])
    runs: list[list] = []
    if by_step and usable:
        table = patterns(usable)
        target = np.array([float(sum(c for _, c in by_step.get(k, ()))) for k in range(1, usable + 1)])
        fitted = np.floor(nnls(table.T, target) + 1e-9).astype(np.int64)
        room = target.astype(np.int64)
        for i in np.argsort(-fitted, kind="stable"):
            need = table[i].astype(np.int64)
            repeats = min([int(fitted[i]), *(int(room[k] // need[k]) for k in np.flatnonzero(need))])
            if repeats > 0:
                room -= repeats * need
                runs += _take(by_step, [k + 1 for k in np.flatnonzero(need)[::-1] for _ in range(need[k])], repeats)
    for lengths, repeats in runs:
        for n in lengths:
            left[n] -= repeats
    return _best_fit(runs, left, capacity)


def _take(by_step: dict[int, list[list[int]]], parts: list[int], repeats: int) -> Iterator[list]:
    """Fill ``repeats`` copies of a pattern with real lengths, longest first, as runs of equal sequences."""
    while repeats:
        taken: dict[int, int] = defaultdict(int)
        for k in parts:
            taken[k] += 1
        # The largest number of copies for which each step's last length covers all its parts.
        now = repeats
        for k, need in taken.items():
            now = min(now, by_step[k][-1][1] // need)
        if now:
            lengths = [by_step[k][-1][0] for k in parts]
            for k, need in taken.items():
                by_step[k][-1][1] -= now * need
        else:  # a step's longest length runs out inside one copy
            now, lengths = 1, []
            for k in parts:
                while not by_step[k][-1][1]:
                    by_step[k].pop()
                lengths.append(by_step[k][-1][0])
                by_step[k][-1][1] -= 1
        for k in taken:
            while by_step[k] and not by_step[k][-1][1]:
                by_step[k].pop()
        repeats -= now
        yield [tuple(lengths), now]


def _best_fit(runs: list[list], left: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Put what is left, longest first, into the fullest sequences that have room, opening new ones at need."""
    open_: dict[int, list[list]] = defaultdict(list)
    done: list[tuple[tuple[int, ...], int]] = []

    def put(lengths: tuple[int, ...], repeats: int, free: int) -> None:
        if free:
            open_[free].append([lengths, repeats])
        else:
            done.append((lengths, repeats))

    for lengths, repeats in runs:
        put(lengths, repeats, capacity - sum(lengths))
    for n in sorted((k for k, c in left.items() if c), reverse=True):
        count = left[n]
        fits = sorted(k for k, found in open_.items() if k >= n and found)
        while count and fits:
            free = fits[0]
            if not open_[free]:
                fits.pop(0)
                continue
            lengths, repeats = open_[free].pop()
            each = min(free // n, max(1, count // repeats))
            use = min(repeats, count // each)
            if use < repeats:
                open_[free].append([lengths, repeats - use])
            count -= use * each
            rest = free - n * each
            put(lengths + (n,) * each, use, rest)
            if rest >= n:
                fits = sorted({*fits, rest})
        if count:
            each = capacity // n
            whole, rest = divmod(count, each)
            if whole:
                put((n,) * each, whole, capacity - each * n)
            if rest:
                put((n,) * rest, 1, capacity - rest * n)
    return done + [(lengths, repeats) for found in open_.values() for lengths, repeats in found]


def tokenized(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int, doc_id: str, text: str) -> DataFrame:
    """One row per piece, with the task that made it and its number among that task's pieces of its length."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids_of, part, seen = Ids(tokenizer_path), TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            names, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for run in pieces(texts):
                rows = []
                for name, t in zip(names[run], texts[run], strict=True):
                    ids = ids_of(t or "", end_id)
                    for k, a in enumerate(range(0, len(ids), capacity)):
                        piece = ids[a:a + capacity]
                        rows.append((name, k, a, len(piece), zlib.crc32(piece.tobytes()), part, seen[len(piece)]))
                        seen[len(piece)] += 1
                yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "part", "number"]).astype({"doc_id": object})

    columns = f"doc_id {dict(docs.dtypes)[doc_id]}, piece int, start long, length long, ids_crc32 long, part int, number long"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(cut, columns)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens: one row per piece.

    Returns ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``. A document ends with
    ``end_id``; a null or empty text is that id alone. Only documents longer than ``capacity`` are
    cut. Repeated rows are packed as often as they come; a null id stays null; an empty table gives an
    empty one. The driver gets the histogram of lengths, at most ``capacity`` rows.
    """
    found = written(tokenized(docs, tokenizer_path, capacity, end_id, doc_id, text), "packing")
    counts = found.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    # One row for each task that made pieces of this length.
    before = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    numbered = found.join(offsets, ["part", "length"]).withColumn("_nth", F.col("number") + F.col("_before"))
    places = docs.sparkSession.sparkContext.broadcast(_places(plan(histogram, capacity)))  # bounded by the plan

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, first, sequence, offset = places.value
        for batch in batches:
            # Runs are ordered by length and by number within it; a piece belongs to the last that begins at or before it.
            length, nth = batch["length"].to_numpy(), batch["_nth"].to_numpy()
            at = np.empty(len(batch), dtype=np.int64)
            for n in np.unique(length):
                begin, end = keys.get(int(n))
                mine = length == n
                at[mine] = begin + np.searchsorted(first[begin:end], nth[mine], side="right") - 1
            batch["sequence_id"] = sequence[at] + nth - first[at]
            batch["offset"] = offset[at]
            yield batch[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    kind = dict(found.dtypes)["doc_id"]
    return numbered.select("doc_id", "piece", "start", "length", "ids_crc32", "_nth").mapInPandas(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def _places(runs: list[tuple[tuple[int, ...], int]]):
    """The plan by length: from which number on pieces go to which sequence and offset."""
    rows, used, sequence = [], defaultdict(int), 0
    for lengths, repeats in runs:
        offset = 0
        for n in lengths:
            rows.append((n, used[n], sequence, offset))
            used[n] += repeats
            offset += n
        sequence += repeats
    rows.sort()
    table = np.array(rows, dtype=np.int64).reshape(-1, 4)
    lengths, begin = np.unique(table[:, 0], return_index=True)
    keys = {int(n): (int(a), int(b)) for n, a, b in zip(lengths, begin, np.r_[begin[1:], len(table)])}
    return keys, table[:, 1].copy(), table[:, 2].copy(), table[:, 3].copy()
