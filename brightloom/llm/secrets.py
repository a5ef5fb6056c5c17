"""Secret scans: fixed patterns, and a linear-chain conditional random field that adds spans.

The words of a line are tagged begin, inside or outside of a secret. A word's features are its shape, the
words around it and counts of its file; the best tags come from Viterbi. The field is trained on lines
whose tags follow from the patterns, and on the same lines with the secret masked: its key, its sign and its
alphabet are replaced, so that shape and surroundings must carry the tag, and in some the secret itself by a
plain word, so that a key alone must not. It then finds secrets that no pattern names.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

# The three patterns, in the order in which spans of equal start are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "crf")
LEAST = {"assign": 6, "access": 20, "hex": 24}

OUT, BEGIN, INSIDE = range(3)
_KEYS = frozenset("password passwd pwd secret token apikey api_key key auth bearer credential credentials access_key private_key".split())
_STARTS = ("passw", "secret", "token", "apikey", "api_key")
_DIGIT, _RUN = re.compile(r"\d"), re.compile(r"\d+|[A-Z]+|[^\dA-Z]+")
_HEX_WORD, _ODD_SIGN = re.compile(r"[0-9a-f]{8,}"), re.compile(r"[^\w+/=.-]")
#: Counts, dates, addresses of machines and numbers of telephones, with what follows a sentence.
_NUMBER = re.compile(r"[\d.:/+()-]*+[^\w]*+")
#: Plain words, of up to 11 letters of which only the first may be upper case, are passed over; the next other word is caught.
_OTHER = re.compile(r"\s*+(?:[A-Za-zÀ-ÖØ-öø-ÿ][a-zß-öø-ÿ]{0,10}+[.,;!?]*+(?:\s++|\Z))*+(\S*+)")
_KEY = re.compile("|".join(sorted(_KEYS)), re.IGNORECASE)
_EDGES = "\"'`()[]{}<>,;"
#: Words whose scores a worker remembers.
_MEMO = 200_000


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the three patterns, leftmost and non-overlapping for each kind."""
    found = []
    low = text.lower()
    if any(s in low for s in _STARTS):
        found += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        found += [(*m.span(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # The same runs as the hex pattern with the short ones dropped: a run is matched whole or not at all.
    found += [(*m.span(), "hex") for m in _LONG_HEX.finditer(text)]
    return found


def _core(word: str) -> str:
    return word.strip(_EDGES)


def _value(word: str) -> str:
    """What stands after a key and its sign inside one word, such as ``key=value``; else the word."""
    core = _core(word)
    for sign in ("=", ":"):
        head, found, tail = core.partition(sign)
        if found and tail and head.strip("\"'").lower() in _KEYS:
            return _core(tail)
    return core


def shape(word: str) -> list[str]:
    """Features of a word alone."""
    value, core = _value(word), _core(word)
    n, digits = len(value), len(_DIGIT.findall(value))
    out = [f"length {min(n // 4, 10)}", f"kinds {min(len(set(value)) // 4, 6)}",
           f"runs {min(len(_RUN.findall(value)) // 3, 6)}", f"digits {0 if not n else math.ceil(4 * digits / n)}"]
    if _HEX_WORD.fullmatch(value):
        out.append("hex")
    if value.startswith("AKIA"):
        out.append("access start")
    if digits and value != value.lower() and value != value.upper():
        out.append("mixed")
    if _ODD_SIGN.search(value):
        out.append("odd characters")
    if _NUMBER.fullmatch(value):
        out.append("number")
    if core != value:
        out.append("value in word")
    return out


def _role(word: str) -> str | None:
    """What a word tells about its neighbours: a key name, a sign of assignment, or both."""
    core = word.strip("\"'`()[]{},;").lower()
    if core in ("=", ":", ":=", "=>", "->"):
        return "sign"
    name = core.rstrip(":=")
    if name.strip("\"'") in _KEYS:
        return "key sign" if name != core else "key"
    return None


def _around(words: Sequence[str], i: int) -> list[str]:
    one, two = (_role(words[i - back]) or "" if i >= back else "" for back in (1, 2))
    return ["sign before"] * ("sign" in one) + ["key before"] * ("key" in one or "key" in two)


def file_features(text: str) -> list[str]:
    """Features shared by all words of a text: its length, and how many keys it names."""
    low = text.lower()
    keys = sum(low.count(s) for s in _STARTS)
    return [f"file length {min(len(text).bit_length() // 3, 6)}", f"file keys {min(keys, 3)}"]


@dataclass(frozen=True)
class Field:
    """Weights by feature and tag, and by pair of tags; tag ``OUT`` scores 0 by convention of training."""

    index: dict[str, int]
    weights: np.ndarray
    moves: np.ndarray
    start: np.ndarray

    def emission(self, features: Sequence[str]) -> np.ndarray:
        rows = [self.index[f] for f in features if f in self.index]
        return self.weights[rows].sum(0) if rows else np.zeros(3)


def viterbi(emissions: np.ndarray, moves: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The best tags; ties go to the smaller tag."""
    score, back = emissions[0] + start, []
    for e in emissions[1:]:
        steps = score[:, None] + moves
        back.append(steps.argmax(0))
        score = steps.max(0) + e
    tags = [int(score.argmax())]
    for b in reversed(back):
        tags.append(int(b[tags[-1]]))
    return np.array(tags[::-1])


def _tagged(line: str, offset: int, spans: Sequence[tuple[int, int, str]]) -> tuple[list[str], list[int]]:
    """Words of a line and their tags: words that a pattern's secret touches are begin and inside."""
    words, tags, last = [], [], None
    for m in re.finditer(r"\S+", line):
        a, b = m.start() + offset, m.end() + offset
        at = next((s for s in spans if s[0] < b and a < s[1]), None)
        if at and _role(m[0]):
            at = None  # the key's name and the sign are no part of the secret
        tags.append(OUT if at is None else INSIDE if at == last else BEGIN)
        words.append(m[0])
        last = at
    return words, tags


def _lines(text: str) -> Iterator[tuple[int, str]]:
    at = 0
    for line in text.split("\n"):
        yield at, line
        at += len(line) + 1


#: How a masked secret may stand to its key; the last forms have none.
_FORMS = ("{k} = {v}", "{k}: {v}", "{k}={v}", '"{k}": "{v}"', "{k} is {v}", "{k} {v}", "{v}", "{v}")
_PLAIN_FORMS = ("{k}: {v}", "{k} {v}", "{k} is {v}", "{k} = {v}", "{v}")
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_ALPHABETS = (_LETTERS + _LETTERS.upper() + "0123456789", _LETTERS + "0123456789", _LETTERS.upper() + "0123456789", "0123456789abcdef",
              _LETTERS + _LETTERS.upper() + "0123456789+/_-")
#: Secrets that are masked, and masks of each.
MASKED, MASKS = 1000, 4


def _masked(before: list[str], after: list[str], draw: random.Random) -> Iterator[tuple[list[str], list[int]]]:
    """Words and tags around a secret of another key, sign and alphabet, and around a plain word and a number."""
    names, plain = sorted(_KEYS), [w for w in [*before, *after] if w.isalpha()] or ["word"]
    for turn in range(MASKS + 2):
        if turn < MASKS:
            letters = draw.choice(_ALPHABETS)
            value = "".join(draw.choice(letters) for _ in range(draw.randint(16, 44)))
            form = draw.choice(_FORMS)
        else:
            number = draw.choice("./:-").join(str(draw.randint(0, 999)) for _ in range(draw.randint(1, 5)))
            value, form = draw.choice(plain) if turn == MASKS else number, draw.choice(_PLAIN_FORMS)
        placed = form.format(k=draw.choice(names), v=value).split(" ")
        tags = [BEGIN if turn < MASKS and value in w else OUT for w in placed]
        yield [*before, *placed, *after], [OUT] * len(before) + tags + [OUT] * len(after)


def _sequences(texts: Sequence[str], window: int = 6) -> list[tuple[list[list[str]], list[int]]]:
    """Training sequences: words around each secret and its masks, and one stretch without a secret from each text."""
    out, masked, draw = [], 0, random.Random(7)
    for text in texts:
        spans = base_spans(text)
        assigned = [(m.start(2), m.end(2), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
        marks = assigned + [s for s in spans if s[2] != "assign" and not any(a[0] < s[1] and s[0] < a[1] for a in assigned)]
        common = file_features(text)
        for k, (at, line) in enumerate(_lines(text)):
            words, tags = _tagged(line, at, marks)
            if not words:
                continue
            ones = [i for i, t in enumerate(tags) if t == BEGIN] or ([len(words) // 2] if k == 0 else [])
            for i in ones:
                part = range(max(0, i - window), min(len(words), i + window + 1))
                out.append(([shape(words[j]) + _around(words, j) + common for j in part], [tags[j] for j in part]))
                if tags[i] != BEGIN or masked >= MASKED:
                    continue
                masked += 1
                begin = next(j for j in range(i, -1, -1) if j == 0 or not _role(words[j - 1]))  # without the key
                end = next((j for j in range(i + 1, len(words)) if tags[j] != INSIDE), len(words))
                around = [w for j, w in enumerate(words) if max(0, begin - window) <= j < begin and tags[j] == OUT], words[end:end + window]
                for others, marks_ in _masked(*around, draw):
                    out.append(([shape(w) + _around(others, j) + common for j, w in enumerate(others)], marks_))
    return out


def train(texts: Sequence[str], rounds: int = 100, rate: float = 0.3, penalty: float = 0.01) -> Field:
    """Maximum likelihood with a square penalty, by forward-backward and adaptive steps."""
    sequences = _sequences(texts)
    names = sorted({f for words, _ in sequences for w in words for f in w})
    index = {f: i for i, f in enumerate(names)}
    weights, moves, start = np.zeros((len(names) + 1, 3)), np.zeros((3, 3)), np.zeros(3)
    if not sequences:
        return Field(index, weights, moves, start)
    deep = max(len(w) for w, _ in sequences)
    wide = max(len(f) for words, _ in sequences for f in words)
    n = len(sequences)
    feature = np.full((n, deep, wide), len(names))  # the last row of weights stays 0
    tag, live = np.zeros((n, deep), int), np.zeros((n, deep), bool)
    for s, (words, tags) in enumerate(sequences):
        live[s, :len(words)], tag[s, :len(tags)] = True, tags
        for i, fs in enumerate(words):
            feature[s, i, :len(fs)] = [index[f] for f in fs]
    both = live[:, 1:] & live[:, :-1]
    seen = np.eye(3)[tag] * live[..., None]
    pairs = np.einsum("sta,stb->ab", seen[:, :-1] * both[..., None], seen[:, 1:])
    values = [weights, moves, start]
    squares = [np.full_like(v, 1e-8) for v in values]
    for _ in range(rounds):
        emit = weights[feature].sum(2)
        forward, backward = np.zeros((n, deep, 3)), np.zeros((n, deep, 3))
        forward[:, 0] = emit[:, 0] + start
        for t in range(1, deep):
            step = np.logaddexp.reduce(forward[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
            forward[:, t] = np.where(live[:, t, None], step, forward[:, t - 1])
        for t in range(deep - 2, -1, -1):
            step = np.logaddexp.reduce(moves + (emit[:, t + 1] + backward[:, t + 1])[:, None, :], axis=2)
            backward[:, t] = np.where(live[:, t + 1, None], step, 0.0)
        whole = np.logaddexp.reduce(forward[:, -1], axis=1)
        chance = np.exp(forward + backward - whole[:, None, None]) * live[..., None]
        joint = np.exp(forward[:, :-1, :, None] + moves + (emit + backward)[:, 1:, None, :] - whole[:, None, None, None])
        error = seen - chance
        slope = np.zeros_like(weights)
        for t in range(3):
            slope[:, t] = np.bincount(feature.ravel(), np.repeat(error[..., t].ravel(), wide), len(slope))
        slope[-1] = 0
        slopes = [slope, pairs - (joint * both[..., None, None]).sum((0, 1)), (seen[:, 0] - chance[:, 0]).sum(0)]
        for value, square, g in zip(values, squares, slopes):
            g = g - penalty * value
            square += g * g
            value += rate * g / np.sqrt(square)
    return Field(index, weights, moves, start)


def fit(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", rows: int = 3000, longest: int = 20_000) -> Field:
    """Train on about ``rows`` texts, chosen by a hash of the id, half of them with a secret named by a pattern.

    Twice ``rows`` texts of at most ``longest`` code points are the documented bound of what the driver gets; longer
    texts are not learned from, but scanned like all others.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter(F.length("text") <= longest)
    named = F.col("text").rlike(f"(?i)({ASSIGN.pattern})|AKIA[A-Z0-9]{{16,}}|(?-i)[0-9a-f]{{24,}}")
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    sized = texts.agg(F.count("*").alias("n")).first()["n"]
    # A secret turns up in few texts: look for them in a sample that is larger by a fixed factor.
    often, seldom = min(1.0, 20 * rows / max(1, sized)), min(1.0, rows / 2 / max(1, sized))
    sample = texts.filter((drawn < seldom * (1 << 20)) | ((drawn < often * (1 << 20)) & named))
    found = sample.orderBy("doc_id", "text").select("text").limit(2 * rows).toPandas()["text"].tolist()
    return train(found)


def scan(docs: DataFrame, field: Field, text: str = "text", out: str = "secrets") -> DataFrame:
    """Add ``out``: an array of ``kind, start, end`` (code points, end exclusive) by start, then kind.

    The spans of the patterns are always there; spans of the field (kind ``crf``) are added where they
    touch none of them. A null or empty text has none. Other columns pass through (a column named like
    ``out`` is replaced). Whole texts are read. Lines in which no word can score above outside
    are not decoded, which changes nothing: all-outside is their best tagging.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # bounded by the number of features

    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = Tagger(shared.value)
        for texts in batches:
            yield pd.Series([tagger.spans(t) if isinstance(t, str) and t else [] for t in texts])

    return docs.withColumn(out, find(F.col(text)))


def redact(docs: DataFrame, field: Field, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """Replace every secret of ``text`` by ``mark``; touching or overlapping spans become one. A null text stays null."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        tagger = Tagger(shared.value)
        for texts in batches:
            yield pd.Series([tagger.redacted(t, mark) if isinstance(t, str) else None for t in texts], dtype=object)

    return docs.withColumn(text, clean(F.col(text)))


class Tagger:
    """Decodes texts with one field, remembering the words that cannot be part of a secret."""

    def __init__(self, field: Field) -> None:
        self.field = field
        moves = field.moves - field.moves[OUT, OUT]
        out_free = np.array([moves[BEGIN, OUT], moves[INSIDE, OUT], 0.0])
        # No segment gains more than this for each of its words: entering or staying, and once leaving.
        self.bonus = float(max(moves[OUT, BEGIN], moves[:, BEGIN].max(), moves[:, INSIDE].max(),
                               (field.start - field.start[OUT]).max()) + out_free.max())
        common = [(w[1:] - w[0]).max() for f, w in zip(field.index, field.weights) if f.startswith("file ")]
        self.bonus += 2 * max([0.0, *common])
        self.known: dict[str, np.ndarray] = {}
        gain = {f: (w[1:] - w[0]).max() for f, w in zip(field.index, field.weights)}

        # Most that a plain word can score: it has a length below 12, and no more kinds of letters than letters.
        sizes = max(gain.get(f"length {n}", 0.0) + gain.get(f"kinds {k}", 0.0) for n in range(3) for k in range(n + 1))
        self.plain = sizes + gain.get("runs 0", 0.0) + gain.get("digits 0", 0.0) + max(0.0, gain.get("hex", 0.0)) + self.bonus

    def emission(self, word: str) -> np.ndarray:
        """Scores of a word alone, remembered; the store is emptied when it is full."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) > _MEMO:
                self.known = {}
            found = self.known[word] = self.field.emission(shape(word))
        return found

    def _hot(self, word: str) -> bool:
        if _role(word):
            return True
        e = self.emission(word)
        return max(e[BEGIN], e[INSIDE]) - e[OUT] + self.bonus > 0

    def hot_places(self, text: str) -> list[int]:
        """Where a word stands that may not be outside; plain words are looked at only if they name a key."""
        if self.plain > 0:
            return [m.start() for m in re.finditer(r"\S+", text) if self._hot(m[0])]
        found = [m.start(1) for m in _OTHER.finditer(text) if m[1] and self._hot(m[1])]
        low = text.lower()
        return found + [m.start() for m in _KEY.finditer(text)] if any(k in low for k in _KEYS) else found

    def tags(self, words: Sequence[str], common: np.ndarray) -> np.ndarray:
        emissions = np.array([self.emission(w) for w in words]) + common
        for i in range(len(words)):
            around = _around(words, i)
            if around:
                emissions[i] += self.field.emission(around)
        return viterbi(emissions, self.field.moves, self.field.start)

    def _field_spans(self, text: str) -> Iterator[tuple[int, int]]:
        common, done = None, 0
        for place in sorted(self.hot_places(text)):
            if place < done:
                continue
            at, done = text.rfind("\n", 0, place) + 1, text.find("\n", place) % (len(text) + 1)
            line = text[at:done]
            common = self.field.emission(file_features(text)) if common is None else common
            marks = list(re.finditer(r"\S+", line))
            tags = self.tags([m[0] for m in marks], common)
            i = 0
            while i < len(marks):
                if tags[i] == OUT:
                    i += 1
                    continue
                j = i + 1
                while j < len(marks) and tags[j] == INSIDE:
                    j += 1
                first, last = marks[i][0], marks[j - 1][0]
                a = marks[i].start() + first.find(_value(first)) if _value(first) else marks[i].start()
                b = marks[j - 1].start() + len(last.rstrip(_EDGES + ".!?"))
                if b > a:
                    yield at + a, at + b
                i = j

    def redacted(self, text: str, mark: str) -> str:
        out, at = [], 0
        for span in self.spans(text):
            if span["start"] > at or not out:
                out += [text[at:span["start"]], mark]
            at = max(at, span["end"])
        return "".join([*out, text[at:]])

    def spans(self, text: str) -> list[dict]:
        base = base_spans(text)
        taken = np.array(sorted((a, b) for a, b, _ in base)).reshape(-1, 2)
        added = [(a, b, "crf") for a, b in self._field_spans(text) if not ((taken[:, 0] < b) & (a < taken[:, 1])).any()]
        ordered = sorted(base + added, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))
        return [{"kind": k, "start": a, "end": b} for a, b, k in ordered]


def digest(spans_column) -> tuple:
    """Columns of the query: counts by kind, the hash of the patterns' spans, and all spans as text."""
    base = F.filter(spans_column, lambda s: s["kind"] != "crf")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter(spans_column, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return *map(count, KINDS[:3]), F.sha2(joined(base), 256).alias("base_sha256"), joined(spans_column).alias("spans")
