"""Sorting, first and last rows, ordered splits and folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brightloom.operators.positions import with_group_position, with_position


def sorted_partitions(df: DataFrame, partitions: int, *order: Column) -> DataFrame:
    """Total order over a given number of partitions."""
    return df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def first_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first ``n`` rows in ``order``; each task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)


def first_distinct(df: DataFrame, column: str, row_id: str, n: int) -> DataFrame:
    """The first ``n`` distinct values in order of appearance."""
    return df.groupBy(column).agg(F.min(row_id).alias("first_at")).orderBy("first_at").limit(n)


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group. Spark cuts each group to ``k`` before the shuffle too."""
    window = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= k)


def ordered_split(df: DataFrame, order: Sequence[str], test_share: float, tag: str = "split", accuracy: int = 10_000) -> DataFrame:
    """Tag the first ``test_share`` of the rows in ascending ``order`` as test, the rest as train.

    Only the last test row is looked for: a mergeable sketch of the first column brackets it, and the rows
    inside the bracket alone are sorted. Rows alike in all of ``order`` stay together; nulls come first.
    """
    n = df.count()
    n_test = int(n * test_share)
    if not n_test:
        return df.withColumn(tag, F.lit("train"))
    first, share = F.col(order[0]), n_test / n
    edges = [max(share - 2.0 / accuracy, 0.0), min(share + 2.0 / accuracy, 1.0)]
    low, high = df.agg(F.percentile_approx(first, edges, accuracy)).first()[0] or (None, None)
    inside, below = F.lit(True), 0
    if low is not None:
        near = first.between(F.lit(low), F.lit(high))
        under, met = df.agg(F.count_if(first.isNull() | (first < F.lit(low))), F.count_if(near)).first()
        if under < n_test <= under + met:
            inside, below = near, under
    placed = with_position(df.filter(inside).select(*order), [F.col(c).asc_nulls_first() for c in order], "_at")
    last = placed.filter(F.col("_at") == n_test - 1 - below).first()
    kinds = dict(df.dtypes)
    border = F.struct(*[F.lit(last[c]).cast(kinds[c]).alias(c) for c in order])
    return df.withColumn(tag, F.when(F.struct(*order) <= border, "test").otherwise("train"))


def integer_hash(key: Column) -> Column:
    """A mixing hash of a whole-number key that any SQL engine can repeat."""
    small = F.pmod(key, F.lit(2147483647).cast("bigint"))
    return F.pmod(small * F.lit(2654435761).cast("bigint"), F.lit(4294967296).cast("bigint"))


def hash_split(df: DataFrame, key: str, train_percent: int, tag: str = "split") -> DataFrame:
    """Stable random split by key: every row keeps its part in every run."""
    bucket = F.pmod(F.floor(integer_hash(F.col(key)) / 65536), F.lit(100))
    return df.withColumn(tag, F.when(bucket < train_percent, "train").otherwise("test"))


def stratified_folds(df: DataFrame, label: str, key: str, k: int, fold: str = "fold") -> DataFrame:
    """Deal the rows of each class to ``k`` folds in turn, in hash order, so class shares agree."""
    hashed = df.withColumn("_hash", integer_hash(F.col(key)))
    placed = with_group_position(hashed, [label], ["_hash", key], "_at")
    return placed.withColumn(fold, F.pmod("_at", F.lit(k)).cast("int")).drop("_hash", "_at")


def plain_folds(df: DataFrame, key: str, k: int, fold: str = "fold") -> DataFrame:
    """Deal all rows to ``k`` folds in turn, in hash order."""
    hashed = df.withColumn("_hash", integer_hash(F.col(key)))
    placed = with_position(hashed, ["_hash", key], "_at")
    return placed.withColumn(fold, F.pmod("_at", F.lit(k)).cast("int")).drop("_hash", "_at")
