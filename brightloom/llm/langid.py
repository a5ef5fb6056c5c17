"""Language ID by multilingual mixtures: each word is drawn from one of the document's languages.

A language is a character trigram model. Expectation-maximisation estimates the share of each language in
a document from the likelihoods of its words; the set of languages is the one with the best likelihood
after a penalty for each further language.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from brightloom.llm.common import pieces

UNKNOWN = "und"
_EDGE = " "
_SHIFT = 21  # bits of a code point
#: Words whose likelihoods a worker keeps; the store is emptied when it is full.
_MEMO = 200_000


def held_out(doc_id: Column) -> Column:
    """True where the id's checksum says that the row must not be learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


@dataclass(frozen=True)
class Model:
    """Sorted trigram keys with a log-probability for each language; unseen trigrams get ``unseen``."""

    languages: tuple[str, ...]
    keys: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    unseen: np.ndarray
    new_context: float


def _letters(word: str) -> str:
    return "".join(filter(str.isalpha, word)).lower()


def _trigram_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Trigrams of the words of each batch, counted by language."""
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            words, grams = Counter(), Counter()
            for text in texts:
                words.update(text.split())
            for word, n in words.items():
                clean = _letters(word)
                if clean:
                    padded = _EDGE + _EDGE + clean + _EDGE
                    for i in range(len(padded) - 2):
                        grams[padded[i:i + 3]] += n
            yield pd.DataFrame({"lang": lang, "gram": list(grams), "n": list(grams.values())})


def _key(codes: np.ndarray) -> np.ndarray:
    """One whole number for each three neighbouring code points."""
    return (codes[:-2] << (2 * _SHIFT)) | (codes[1:-1] << _SHIFT) | codes[2:]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
        docs_per_language: int = 2000, smoothing: float = 0.05) -> Model:
    """Learn from the rows with text and language that are not held out.

    ``docs_per_language`` bounds the expected number of rows of a language that are used, chosen by
    a hash of the id. Trigrams are counted in Spark; the driver gets one row for each language and
    trigram. The number of languages is taken to be small.
    """
    usable = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang")
    ).filter(F.col("text").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["count"] for r in usable.groupBy("lang").count().collect()}
    share = F.lit(0.0)
    for name, n in sizes.items():
        share = F.when(F.col("lang") == name, F.lit(min(1.0, docs_per_language / n))).otherwise(share)
    drawn = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20)
    counts = (
        usable.filter(drawn).mapInPandas(_trigram_counts, "lang string, gram string, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas())
    return _model(tuple(sorted(counts["lang"].unique())), counts, smoothing)


def _model(languages: tuple[str, ...], counts: pd.DataFrame, smoothing: float) -> Model:
    codes = {g: int(_key(np.array([ord(c) for c in g], dtype=np.int64))[0]) for g in counts["gram"].unique()}
    keys = np.array(sorted(codes.values()), dtype=np.int64)
    table = np.zeros((len(keys), len(languages)))
    column = {name: i for i, name in enumerate(languages)}
    np.add.at(table, (np.searchsorted(keys, counts["gram"].map(codes).to_numpy(dtype=np.int64)),
                      counts["lang"].map(column).to_numpy(dtype=np.int64)), counts["n"].to_numpy(dtype=float))
    alphabet = max(2, len({k & ((1 << _SHIFT) - 1) for k in keys.tolist()}))
    contexts, place = np.unique(keys >> _SHIFT, return_inverse=True)
    totals = np.zeros((len(contexts), len(languages)))
    np.add.at(totals, place, table)
    below = totals + smoothing * alphabet
    return Model(languages, keys, np.log((table + smoothing) / below[place]), contexts,
                 np.log(smoothing / below), -float(np.log(alphabet)))


def word_logs(model: Model, words: list[str]) -> np.ndarray:
    """Log-likelihood of each word under each language; a row of NaN for words without letters."""
    out = np.full((len(words), len(model.languages)), np.nan)
    clean = [_letters(w) for w in words]
    kept = [i for i, w in enumerate(clean) if w]
    if not kept:
        return out
    codes = np.frombuffer("".join(_EDGE + _EDGE + clean[i] + _EDGE for i in kept).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    lengths = np.array([len(clean[i]) + 3 for i in kept])
    ends = np.cumsum(lengths)
    keys = _key(codes)
    at = np.minimum(np.searchsorted(model.keys, keys), len(model.keys) - 1)
    home = np.minimum(np.searchsorted(model.contexts, keys >> _SHIFT), len(model.contexts) - 1)
    logs = np.where((model.contexts[home] == keys >> _SHIFT)[:, None], model.unseen[home], model.new_context)
    logs = np.where((model.keys[at] == keys)[:, None], model.logs[at], logs)
    inside = np.ones(len(keys), dtype=bool)  # windows over the seam of two words are left out
    for back in (1, 2):
        seam = ends[:-1] - back
        inside[seam[seam < len(keys)]] = False
    logs[~inside] = 0.0
    out[kept] = np.add.reduceat(logs, ends - lengths)
    return out


def _shares(chance: np.ndarray, counts: np.ndarray, doc: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int):
    """EM for all documents of a batch at once: shares and log-likelihood (up to each word's own constant)."""
    shares = allowed / allowed.sum(1, keepdims=True)
    total = np.add.reduceat(counts, first)[:, None]
    for _ in range(rounds):
        part = chance * shares[doc]
        part *= (counts / np.maximum(part.sum(1), 1e-300))[:, None]
        shares = np.add.reduceat(part, first, axis=0) / total
    level = np.log(np.maximum((chance * shares[doc]).sum(1), 1e-300))
    return shares, np.add.reduceat(counts * level, first)


def mixtures(logs: np.ndarray, counts: np.ndarray, doc: np.ndarray, rounds: int = 12, penalty: float = 2.0):
    """Best language and its share for each document; rows are the distinct words, ordered by document.

    Sets of languages are tried from the largest estimated share down. A set of ``k`` languages pays
    ``penalty * (k - 1) * ln(words)``. Ties go to the smaller set, then to the first language.
    """
    first = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    place = np.cumsum(np.r_[0, doc[1:] != doc[:-1]])
    top = logs.max(1, keepdims=True)
    chance = np.exp(logs - top)
    n, width = len(first), logs.shape[1]
    words = np.add.reduceat(counts, first)
    single = np.add.reduceat(counts[:, None] * (logs - top), first, axis=0)
    best, score = single.argmax(1), np.ones(n)
    value = single.max(1)
    price = penalty * np.log(np.maximum(words, 2.0))
    # No set can beat the sum of each word's best language, which is 0 here.
    open_ = np.flatnonzero(value < -price)
    if width > 1 and len(open_):
        use = np.isin(place, open_)
        sub_doc = np.searchsorted(open_, place[use])
        sub_first = np.flatnonzero(np.r_[True, sub_doc[1:] != sub_doc[:-1]])
        sub = (chance[use], counts[use], sub_doc, sub_first)
        full, level = _shares(*sub, np.ones((len(open_), width)), rounds)
        order = np.argsort(-full, axis=1, kind="stable")
        for k in range(2, width + 1):
            if k < width:
                allowed = np.zeros((len(open_), width))
                np.put_along_axis(allowed, order[:, :k], 1.0, axis=1)
                shares, level_k = _shares(*sub, allowed, rounds)
            else:
                shares, level_k = full, level
            better = level_k - (k - 1) * price[open_] > value[open_]
            at = open_[better]
            value[at] = (level_k - (k - 1) * price[open_])[better]
            best[at] = shares[better].argmax(1)
            score[at] = shares[better].max(1)
    return best, score


def identify(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """Add the struct ``out`` with ``lang`` and ``score`` (share of the language, 0 to 1).

    A null text, a text without letters, or a model that learned nothing gives ``und`` and 0. Other
    columns pass through (a column named like ``out`` is replaced); whole texts are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by languages x trigrams

    @F.pandas_udf("lang string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        index: dict[str, int] = {}
        store = np.zeros((0, len(model.languages)))
        for batch in batches:
            batch = batch.tolist()
            lang, score = np.full(len(batch), UNKNOWN, dtype=object), np.zeros(len(batch))
            for piece in pieces(batch):
                if len(index) > _MEMO:
                    index, store = {}, store[:0]
                split = [t.split() if isinstance(t, str) and model.languages else [] for t in batch[piece]]
                fresh = list(dict.fromkeys(w for words in split for w in words if w not in index))
                if fresh:
                    index.update(zip(fresh, range(len(index), len(index) + len(fresh)), strict=True))
                    store = np.vstack([store, word_logs(model, fresh)])
                width = max(1, len(index))
                keys, counts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i, words in enumerate(split):
                    k, n = np.unique(np.fromiter(map(index.__getitem__, words), np.int64, len(words)), return_counts=True)
                    keys.append(k + i * width)
                    counts.append(n)
                key, n = np.concatenate(keys), np.concatenate(counts).astype(float)
                rows = store[key % width]
                real = ~np.isnan(rows).any(1)
                if real.any():
                    doc = (key // width)[real]
                    best, share = mixtures(rows[real], n[real], doc)
                    which = doc[np.r_[True, doc[1:] != doc[:-1]]] + piece.start
                    lang[which] = np.array(model.languages, dtype=object)[best]
                    score[which] = np.minimum(share, 1.0)
            yield pd.DataFrame({"lang": lang, "score": score})

    # Spark may work out a deterministic column again for every filter on it.
    return docs.withColumn(out, predict.asNondeterministic()(F.col(text)))
