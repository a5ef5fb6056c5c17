"""Joins by shared columns, membership, row position and value order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brightloom.operators.positions import with_position, with_running_sums


def join_on_shared(*tables: DataFrame) -> DataFrame:
    """Inner equi-join of several tables, each on the column names it shares with those before it.

    No side is hinted: the planner broadcasts a side whose size it knows to be small
    and adaptive execution splits skewed keys of the others.
    """

    def pair(left: DataFrame, right: DataFrame) -> DataFrame:
        shared = [c for c in right.columns if c in left.columns]
        if not shared:
            raise ValueError("tables share no column name")
        return left.join(right, shared)

    return reduce(pair, tables)


def members_of(df: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``column`` occurs in ``keys``; no key list passes through the driver."""
    return df.join(keys.select(F.col(key).alias(column)), column, "left_semi").select(*df.columns)


def side_by_side(
    left: DataFrame, left_order: Sequence[str | Column], right: DataFrame, right_order: Sequence[str | Column],
    position: str = "position",
) -> DataFrame:
    """Pair rows of two tables by their position; the shorter table is padded with nulls."""
    return with_position(left, left_order, position).join(
        with_position(right, right_order, position), position, "full_outer")


def share_at_least(a: DataFrame, b: DataFrame, value: str) -> DataFrame:
    """Share of all pairs (x of a, y of b) with x >= y, without building the pairs.

    Both sides are counted by value; for each value of ``a`` the running count of
    ``b`` up to that value is the number of its winning pairs.
    """
    def counted(df: DataFrame, mine: str, other: str) -> DataFrame:
        return df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias(mine)).withColumn(
            other, F.lit(0).cast("bigint"))

    counts = (
        counted(a, "n_a", "n_b").unionByName(counted(b, "n_b", "n_a"))
        .groupBy(value).agg(F.sum("n_a").alias("n_a"), F.sum("n_b").alias("n_b"))
    )
    ranked = with_running_sums(counts, [value], {"b_up_to": "n_b"})
    wide = "decimal(19,0)"
    pairs = F.sum("n_a").cast(wide) * F.sum("n_b").cast(wide)
    wins = F.sum(F.col("n_a").cast(wide) * F.col("b_up_to").cast(wide))
    return ranked.agg(F.try_divide(wins.cast("double"), pairs.cast("double")).alias("share"))
