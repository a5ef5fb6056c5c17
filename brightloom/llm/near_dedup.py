"""Near-duplicates by SetSketch registers: banded for candidates, weighed by likelihood, verified on full sets.

A register is the floor of a logarithm (base ``BASE``) of the least exponential variate of a set: registers of
a union are the larger ones of its parts, and two sets agree in a register about as often as they
are similar. Groups with an equal band are not spread into pairs: all members are compared with one of
them, and only what that leaves in different components is compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from brightloom.llm.common import pieces, release_shuffles, written
from brightloom.llm.components import components

BANDS, ROWS = 16, 4
REGISTERS = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
#: Candidates are dropped where the data are so much likelier (in logs) below the threshold: five deviations.
DOUBT = 12.5
#: Shingles of a block (each document counts for 256 more), and of a slice of their table of occurrences.
BLOCK, _SLICE = 1 << 19, 4096
_MEMO = 400_000

_DRAW = np.random.default_rng(7)
_FACTORS = _DRAW.integers(0, 1 << 63, REGISTERS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _DRAW.integers(0, 1 << 63, REGISTERS, dtype=np.uint64)
_STEPS = _DRAW.integers(0, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > _MEMO:
            self.clear()
        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _STEPS[0]
    return h ^ (h >> np.uint64(29))


def shingles(text: str | None, size: int, hashes: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct 64-bit values of a text's shingles; one for a text of fewer words; none without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(size, len(h))
    total = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        total = _mixed(total * _STEPS[1] + h[k:len(h) - width + 1 + k])
    return np.unique(total)


def registers(found: np.ndarray) -> np.ndarray:
    """The registers of a set; those of a union are the elementwise maximum."""
    low = np.full(REGISTERS, ~np.uint64(0))
    for a in range(0, len(found), 4096):
        low = np.minimum(low, (found[a:a + 4096, None] * _FACTORS + _SHIFTS).min(0))
    # The least of exponential variates is the variate of the least uniform one.
    least = -np.log1p(-(low >> np.uint64(11)).astype(float) * 2.0**-53) / RATE
    with np.errstate(divide="ignore"):
        return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP).astype("<u2")


def band_keys(values: np.ndarray) -> list[int]:
    rows = values.reshape(BANDS, ROWS)
    return [xxhash.xxh3_64_intdigest(row.tobytes(), seed=i) - (1 << 63) for i, row in enumerate(rows)]


def log_ratio(n_a: np.ndarray, n_b: np.ndarray, values_a: np.ndarray, values_b: np.ndarray, least: float) -> np.ndarray:
    """How much likelier the registers are at the best similarity than at the best one of at least ``least``.

    Joint likelihood of the numbers of larger, smaller and equal registers, given both set sizes.
    """
    more, less = (values_a > values_b).sum(1), (values_a < values_b).sum(1)
    same = values_a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.linspace(0.0, 1.0, 201)[None, :]

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, None) * (BASE - 1) / BASE) / np.log(BASE)

    possible = (grid <= np.minimum(u / v, v / u) + 0.005)
    up, down = chance(u - v * grid), chance(v - u * grid)
    up, down = np.maximum(up, 1e-9), np.maximum(down, 1e-9)
    level = more[:, None] * np.log(up) + less[:, None] * np.log(down) + same[:, None] * np.log(np.maximum(1 - up - down, 1e-9))
    level = np.where(possible, level, -np.inf)
    top = level.max(1)
    high = np.where(grid >= least - 1e-9, level, -np.inf).max(1)
    return np.where(np.isfinite(high), top - high, np.inf)


def sketched(docs: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """``doc_id, n_shingles, digest, registers, bands`` of every row; the digest stands for the whole set."""

    def sketch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for batch in batches:
            names, texts = batch["doc_id"].tolist(), batch["text"].tolist()
            for run in pieces(texts):
                rows = []
                for name, t in zip(names[run], texts[run], strict=True):
                    found = shingles(t, size, hashes)
                    values = registers(found)
                    digest = xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None
                    rows.append((name, len(found), digest, values.tobytes(), band_keys(values) if len(found) else []))
                yield pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "registers", "bands"]).astype({"doc_id": object})

    kind = dict(docs.dtypes)[doc_id]
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        sketch, f"doc_id {kind}, n_shingles long, digest binary, registers binary, bands array<long>")


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """Pairs that sizes and registers do not rule out."""
    @F.pandas_udf("boolean")
    def possible(n_a: pd.Series, n_b: pd.Series, a: pd.Series, b: pd.Series) -> pd.Series:
        if not len(n_a):
            return pd.Series([], dtype=bool)
        values = [np.frombuffer(b"".join(x), "<u2").reshape(-1, REGISTERS) for x in (a, b)]
        return pd.Series(log_ratio(n_a.to_numpy(float), n_b.to_numpy(float), *values, percent / 100) <= DOUBT)

    for end in ("a", "b"):
        side = reps.select(F.col("doc_id").alias(end), F.col("n_shingles").alias(f"_n_{end}"), F.col("registers").alias(f"_r_{end}"))
        pairs = pairs.join(side, end)
    sizes = (100 * F.least("_n_a", "_n_b") >= percent * F.greatest("_n_a", "_n_b"))
    return pairs.filter(sizes).filter(possible("_n_a", "_n_b", "_r_a", "_r_b")).select("a", "b")


def _linked(pairs: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are as similar as asked; their texts are joined to them."""
    @F.pandas_udf("boolean")
    def similar(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        hashes = _Hashes()
        for left, right in batches:
            out, last, held = [], None, None
            for a, b in zip(left, right):
                if held is None or a != last:
                    last, held = a, shingles(a, size, hashes)
                both = np.sort(np.concatenate([held, shingles(b, size, hashes)]), kind="stable")  # two sorted runs
                shared = int((both[1:] == both[:-1]).sum())
                out.append(100 * shared >= percent * (len(both) - shared))
            yield pd.Series(out, dtype=bool)

    pairs = written(_likely(pairs, reps, percent), "pairs")
    for end in ("b", "a"):
        pairs = pairs.join(texts.withColumnsRenamed({"doc_id": end, "text": f"_{end}"}), end)
    return written(pairs.filter(similar("_a", "_b")).select("a", "b"), "links")


def _counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of sets of ``left`` (rows) and of ``right`` (columns)."""
    out = np.zeros((len(left), len(right)), np.float32)
    every = np.concatenate(left + right)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in left + right])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    starts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    sizes = np.diff(np.r_[starts, len(every)])
    # A value of one set alone is in no intersection.
    shared = np.repeat(sizes > 1, sizes)
    owner, value = owner[shared], np.repeat(np.cumsum(sizes > 1) - 1, sizes)[shared]
    for at in range(0, int(value[-1]) + 1 if len(value) else 0, _SLICE):
        a, b = np.searchsorted(value, [at, at + _SLICE])
        held = np.zeros((len(left) + len(right), min(_SLICE, int(value[-1]) + 1 - at)), np.float32)
        held[owner[a:b], value[a:b] - at] = 1
        out += held[:len(left)] @ held[len(left):].T
    return out


def _block_links(rows: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between rows of different roots, one of block ``i`` and one of block ``j``."""
    sides = []
    for block in (rows["i"].iat[0], rows["j"].iat[0]):
        part = rows[rows["block"] == block]
        sets = [np.frombuffer(x, np.uint64) for x in part["found"]]
        sides.append((part["rep"].to_numpy(), part["root"].to_numpy(), sets, np.array([len(x) for x in sets], np.int64)))
    (ids_a, roots_a, sets_a, n_a), (ids_b, roots_b, sets_b, n_b) = sides
    if not sets_a or not sets_b:
        return rows.iloc[:0][["rep", "root"]].set_axis(["a", "b"], axis=1)
    shared = _counts(sets_a, sets_b).astype(np.int64)
    near = 100 * shared >= percent * (n_a[:, None] + n_b[None, :] - shared)
    x, y = np.nonzero(near & (roots_a[:, None] != roots_b[None, :]))
    links = pd.DataFrame({"a": ids_a[x], "b": ids_b[y], "from": roots_a[x], "to": roots_b[y]})
    return links.drop_duplicates(["from", "to"])[["a", "b"]]  # one link joins two roots


def _linked_in_blocks(apart: DataFrame, reps: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """All links between members of one bucket that hang on different roots.

    A bucket is cut into blocks of about ``BLOCK`` shingles, each row goes once to every pair of blocks that
    its block is in, and the full shingle sets are intersected there. A pair of blocks gives its links alone, so
    the rows grow with the square of the number of blocks, not of documents.
    """
    kind = dict(apart.dtypes)["rep"]

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _Hashes()
        for batch in batches:
            names, contents = batch["rep"].tolist(), batch["text"].tolist()
            for run in pieces(contents):
                found = [shingles(t, size, hashes).tobytes() for t in contents[run]]
                yield pd.DataFrame({"rep": pd.Series(names[run], dtype=batch["rep"].dtype), "found": found})

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for batch in batches:
            for _, rows in batch.groupby(["key", "i", "j"], sort=False):
                if held and (held[-1][["key", "i", "j"]].iloc[0] != rows[["key", "i", "j"]].iloc[0]).any():
                    yield _block_links(pd.concat(held), percent)
                    held = []
                held.append(rows)
        if held:
            yield _block_links(pd.concat(held), percent)

    weights = reps.select(F.col("doc_id").alias("rep"), (F.col("n_shingles") + 256).alias("_w"))
    cuts = apart.join(weights, "rep").groupBy("key").agg(F.ceil(F.sum("_w") / BLOCK).cast("int").alias("n"))
    placed = apart.join(written(cuts, "cuts"), "key").withColumn("block", F.pmod(F.xxhash64("rep"), "n").cast("int"))
    placed = placed.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    placed = placed.select("key", "rep", "root", "block", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"))
    ids = apart.select("rep").distinct()
    found = texts.withColumnRenamed("doc_id", "rep").join(ids, "rep", "left_semi").mapInPandas(sets, f"rep {kind}, found binary")
    met = placed.join(written(found, "sets"), "rep").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    return written(met.mapInPandas(compare, f"a {kind}, b {kind}").distinct(), "links")


def _apart(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of the buckets that span several components, with their root and the bucket's last member."""
    rooted = members.select("key", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    rooted = written(rooted.select("key", "rep", F.coalesce("root", "rep").alias("root")), "rooted")
    spans = rooted.groupBy("key").agg(F.min("root").alias("_low"), F.max("root").alias("_high"), F.max(F.struct("rep", "root")).alias("last"))
    return written(rooted.join(written(spans.filter("_low < _high").select("key", "last"), "spans"), "key"), "apart")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked where ``100 * intersection >= percent * union`` of their word shingles (ASCII
    letters in lower case); ``component_id`` is the smallest id that links lead to, ``kept`` is true for it.
    A text without words (null too) is linked with nothing, a row without id neither: both are
    kept, the latter with a null component. Rows that repeat an id are one document and must agree
    in text; copies are collapsed before anything is compared. An empty table gives an empty one.
    Two documents of the similarity asked for share a band with a probability of 1 - (1 - s**4)**16.
    """
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = written(sketched(texts, "doc_id", "text", size), "sketches")
    usable = found.filter("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = written(usable.groupBy("digest").agg(F.min("doc_id").alias("rep")), "classes")
    first = classes.select(F.col("digest").alias("_d"), F.col("rep").alias("_r"))
    reps = written(
        usable.join(first, (F.col("digest") == F.col("_d")) & (F.col("doc_id") == F.col("_r"))).drop("_d", "_r").dropDuplicates(["doc_id"]), "reps")
    bands = reps.select(F.explode("bands").alias("key"), F.col("doc_id").alias("rep"))
    buckets = bands.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).filter("low < high")
    buckets = written(buckets, "buckets")
    members = written(bands.join(buckets, "key"), "members")

    ids = members.select(F.col("rep").alias("doc_id")).distinct()
    texts = written(texts.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")
    release_shuffles(docs.sparkSession)

    # Every member against the first of its bucket, then against the last where both are still apart.
    tried = written(members.filter("rep <> low").select(F.col("low").alias("a"), F.col("rep").alias("b")).distinct(), "star")
    links = _linked(tried, reps, texts, size, percent)
    roots = components(links)
    apart = _apart(members, roots)
    if not apart.isEmpty():
        far = apart.filter("root <> last.root").select(F.col("rep").alias("a"), F.col("last.rep").alias("b")).distinct()
        far = written(far.join(tried, ["a", "b"], "left_anti"), "star")
        links = links.unionByName(_linked(far, reps, texts, size, percent))
        roots = components(links)
        apart = _apart(members, roots)
        # What is still apart, in blocks: every two members of a bucket meet in a task, only links leave it.
        more = _linked_in_blocks(apart, reps, texts, size, percent)
        if not more.isEmpty():
            roots = components(links.unionByName(more))

    owner = classes.join(roots, classes["rep"] == roots["node"], "left").select("digest", F.coalesce("root", "rep").alias("_root"))
    owner = written(owner, "owners")
    out = found.join(owner, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("_root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (component.isNull() | (component == F.col("doc_id"))).alias("kept"))
