"""Approximate nearest neighbours: probed lists, scanned in column blocks of rotated vectors.

Vectors are rotated at random and dealt to the lists of a coarse clustering. In each probed list a query's
distances grow block of columns by block of columns; after each block a hypothesis test on the partial
distance abandons the candidates that are unlikely to come among the nearest. What is left
has its distance worked out on the original vectors.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brightloom.llm.common import written

#: Vectors of one list in one block; a larger list is cut into several.
BLOCK = 4096
COLUMNS = 16
#: Doubt of the test: a candidate goes when its partial distance is so many scaled deviations too large.
DOUBT = 2.1


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(packed: pd.Series, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(-1, d)


def rotation(d: int, seed: int = 11) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))
    return q * np.sign(np.diag(r))


def centres(sample: np.ndarray, lists: int, rounds: int = 8) -> np.ndarray:
    """Centres of a coarse clustering of the sample, by rounds of nearest assignment and means."""
    found = sample[np.linspace(0, len(sample) - 1, min(lists, len(sample))).astype(int)].copy()
    for _ in range(rounds):
        own = nearest_lists(sample, found, 1)[:, 0]
        count = np.bincount(own, minlength=len(found))
        total = np.zeros_like(found)
        np.add.at(total, own, sample)
        found[count > 0] = total[count > 0] / count[count > 0, None]
    return found


def nearest_lists(x: np.ndarray, found: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each row, nearest first."""
    out = []
    for a in range(0, len(x), 2000):
        far = (found**2).sum(1) - 2 * x[a:a + 2000] @ found.T
        out.append(np.argsort(far, axis=1, kind="stable")[:, :n])
    return np.concatenate(out) if out else np.zeros((0, n), int)


def scan(queries: np.ndarray, block: np.ndarray, k: int, columns: int = COLUMNS, doubt: float = DOUBT) -> Iterator[np.ndarray]:
    """For each query the candidates of a block that the tests leave, both in rotated form.

    The bound is the ``k``-th distance to a first part of the block. A candidate with partial squared distance
    ``p`` over ``m`` of ``d`` columns is abandoned if ``p * d / m`` exceeds the bound times
    ``(1 + doubt / sqrt(m)) ** 2``.
    """
    n, d = block.shape
    head = min(n, max(4 * k, 64))
    parts = [np.ascontiguousarray(block[:, a:a + columns]) for a in range(0, d, columns)]  # one block of columns each
    for q in queries:
        if head < n:
            first = ((block[:head] - q) ** 2).sum(1)
            bound = np.partition(first, min(k, head) - 1)[min(k, head) - 1]
        else:
            bound = np.inf
        live, partial, m = np.arange(n), np.zeros(n), 0
        for i, part in enumerate(parts):
            step = part[live] - q[i * columns:i * columns + part.shape[1]]
            partial = partial + np.einsum("ij,ij->i", step, step)
            m += part.shape[1]
            limit = bound * (1 + doubt / math.sqrt(m)) ** 2 * m / d if m < d else bound * (1 + 1e-9)
            keep = partial <= limit
            live, partial = live[keep], partial[keep]
            if m < d and len(live) > k:  # the k best so far may give a closer bound
                at = np.argpartition(partial, k - 1)[:k]
                bound = min(bound, ((block[live[at]] - q) ** 2).sum(1).max())
        if len(live) > k:
            edge = np.partition(partial, k - 1)[k - 1]
            live = live[partial <= edge * (1 + 1e-9) + 1e-300]
        yield live


def search(vectors: DataFrame, is_query: Column, k: int = 10, vec_id: str = "vec_id", embedding: str = "embedding",
           probes: float = 0.75, sample: int = 20_000) -> DataFrame:
    """The ``k`` nearest of each query row: ``query_id, rank, vec_id, score`` (Euclidean, on original vectors).

    Every row but the query's own is a candidate; ties go to the smaller id. Vectors that are null, zero or
    hold null or non-finite components take no part, nor do rows without id, nor vectors of another
    length than the most common one. Equal vectors are searched as one, of which the ``k + 1``
    smallest ids are kept, so a vector that holds a large part of the rows costs one comparison. Rows that
    repeat an id with the same vector are one. Lists are fitted on about ``sample`` rows, chosen by
    a hash; ``probes`` is the share of lists that a query looks into. No usable row gives no result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(embedding, lambda x: x.cast("double")).alias("v"), is_query.alias("asks"))
    rows = rows.filter(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    common = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d = common["d"]

    @F.pandas_udf("binary")
    def packed(v: pd.Series) -> pd.Series:
        return pd.Series([(np.asarray(x, dtype=np.float64) + 0.0).tobytes() for x in v])

    rows = written(rows.filter(F.size("v") == d).select("vec_id", F.coalesce("asks", F.lit(False)).alias("asks"), packed("v").alias("v")), "vectors")

    # Equal vectors: the k + 1 smallest ids, first within slices of a vector's rows, then of the slices' rest.
    slices = W.partitionBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("vec_id")
    of_vector = W.partitionBy("v").orderBy("vec_id")
    ids = rows.select("v", "vec_id").distinct().withColumn("_n", F.row_number().over(slices)).filter(F.col("_n") <= k + 1)
    ids = ids.withColumn("_n", F.row_number().over(of_vector)).filter(F.col("_n") <= k + 1)
    distinct = written(ids.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "distinct")
    n = distinct.count()

    lists = max(1, math.isqrt(n) // 2)
    share = int(min(1.0, sample / max(1, n)) * (1 << 20))
    picked = distinct.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < share).select("v").orderBy(F.xxhash64("v")).toPandas()["v"]
    turn = rotation(d)
    found = centres(_matrix(picked, d) @ turn, lists)
    shared = spark.sparkContext.broadcast((turn, found))  # lists x columns; lists grow with the root of the rows
    looks = max(1, math.ceil(probes * len(found)))

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, found = shared.value
        for batch in batches:
            if len(batch):
                turned = _matrix(batch["v"], d) @ turn
                yield batch.assign(list=nearest_lists(turned, found, 1)[:, 0], turned=[x.tobytes() for x in turned])

    def ask(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        turn, found = shared.value
        for batch in batches:
            if len(batch):
                turned = _matrix(batch["v"], d) @ turn
                near = nearest_lists(turned, found, looks)
                yield pd.DataFrame({"list": near.ravel(), "q": np.repeat(batch["v"].to_numpy(object), near.shape[1]),
                                    "q_turned": np.repeat(np.array([x.tobytes() for x in turned], dtype=object), near.shape[1])})

    dealt = written(distinct.mapInPandas(deal, "v binary, ids array<long>, list int, turned binary"), "lists")
    sizes = dealt.groupBy("list").agg(F.count("*").alias("n")).select("list", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    # One row per list, so at most half the root of the number of vectors.
    blocks = dealt.join(F.broadcast(sizes), "list").withColumn("block", F.pmod(F.xxhash64("v"), F.col("blocks").cast("long")).cast("int"))
    asked = rows.filter("asks").select("v").distinct().mapInPandas(ask, "list int, q binary, q_turned binary")
    asked = asked.join(F.broadcast(sizes), "list").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))

    def compare(key, queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(queries) and len(block):
            original, turned = _matrix(block["v"], d), _matrix(block["turned"], d)
            ids = block["ids"].tolist()
            for q, live in zip(queries["q"], scan(_matrix(queries["q_turned"], d), turned, k + 1)):
                far = np.sqrt(((original[live] - np.frombuffer(q, np.float64)) ** 2).sum(1))
                best = sorted((f, int(v)) for f, i in zip(far.tolist(), live) for v in ids[i])[:k + 1]
                out += [(q, v, f) for f, v in best]
        return pd.DataFrame(out, columns=["q", "vec_id", "score"])

    hits = asked.groupBy("list", "block").cogroup(blocks.select("list", "block", "v", "turned", "ids").groupBy("list", "block")).applyInPandas(
        compare, "q binary, vec_id long, score double")
    # At most k + 1 rows of each block that was probed.
    best = hits.withColumn("_n", F.row_number().over(W.partitionBy("q").orderBy("score", "vec_id"))).filter(F.col("_n") <= k + 1)
    best = written(best.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near")), "nearest")
    asking = rows.filter("asks").select(F.col("vec_id").alias("query_id"), "v").distinct()
    joined = asking.join(best, asking["v"] == best["q"])
    others = F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    return joined.select("query_id", F.posexplode(others).alias("_n", "_x")).select(
        "query_id", (F.col("_n") + 1).cast("int").alias("rank"), F.col("_x.vec_id").alias("vec_id"), F.col("_x.score").alias("score"))
