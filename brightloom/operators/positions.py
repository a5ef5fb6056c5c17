"""Row numbers and running sums over a total order, without one task holding all rows.

``row_number()`` over a window without partition keys moves the whole table into
one task, and with a hot key it moves the hot group into one task. Here the rows
are range-partitioned on the full order, which splits hot keys as well, and each
partition only needs the totals of the partitions before it: one small row per
partition (or per partition and key).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from brightloom.session import checkpointed

_SLOT = "_slot"
_PART = "_part"
_INDEX = "_index"
_PRIOR = "_prior"


def _as_columns(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def range_sorted(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Globally sorted rows tagged with their partition and their index inside it.

    The result is checkpointed: the tags depend on where the range boundaries fell,
    so they must not be worked out again after an executor is lost.
    """
    columns = _as_columns(order)
    tagged = (
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn(_SLOT, F.monotonically_increasing_id())
    )
    return (
        checkpointed(tagged)
        .withColumn(_PART, F.shiftright(_SLOT, 33))
        .withColumn(_INDEX, F.col(_SLOT).bitwiseAND(F.lit((1 << 33) - 1)))
        .drop(_SLOT)
    )


def _same_piece(pieces: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``pieces`` with its key columns renamed, and the condition that joins it to the sorted rows."""
    renamed = pieces.withColumnsRenamed({_PART: f"{_PART}_2", **{k: f"_key_{k}" for k in keys}})
    condition = F.col(_PART) == F.col(f"{_PART}_2")
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    return renamed, condition


def with_position(df: DataFrame, order: Sequence[str | Column], name: str, start: int = 0) -> DataFrame:
    """Add the position of each row in ``order``, counting from ``start``.

    Break ties in ``order`` with a key where the numbers must be reproducible.
    """
    ranged = range_sorted(df, order)
    # One row per partition, so this window and the broadcast are bounded by the partition count.
    offsets = ranged.groupBy(_PART).agg(F.count("*").alias("_n")).select(
        _PART,
        F.coalesce(
            F.sum("_n").over(W.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias(_PRIOR),
    )
    return (
        ranged.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col(_PRIOR) + F.col(_INDEX) + F.lit(start).cast("bigint"))
        .drop(_PART, _INDEX, _PRIOR)
    )


def with_group_position(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], name: str, start: int = 0
) -> DataFrame:
    """Add the position of each row inside its key group; hot groups span many partitions."""
    ranged = range_sorted(df, [*_as_columns(keys), *_as_columns(order)])
    pieces = ranged.groupBy(_PART, *keys).agg(
        F.min(_INDEX).alias("_first"), F.count("*").alias("_n")
    )
    # At most one row per partition for each key group.
    before = W.partitionBy(*keys).orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    pieces = pieces.withColumn(_PRIOR, F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    return ranged.join(*_same_piece(pieces, keys)).select(
        *df.columns, (F.col(_PRIOR) + F.col(_INDEX) - F.col("_first") + F.lit(start).cast("bigint")).alias(name))


def with_running_sums(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Mapping[str, str],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running sums ``{new name: source column}`` in ``order``, per ``keys`` if given.

    Aggregate to one row per order value first where rows can share a value.
    """
    keys = list(keys)
    ranged = range_sorted(df, [*_as_columns(keys), *_as_columns(order)])
    totals = ranged.groupBy(_PART, *keys).agg(
        *[F.sum(src).alias(f"_t_{new}") for new, src in sums.items()]
    )
    before = W.partitionBy(*keys) if keys else W.partitionBy()
    before = before.orderBy(_PART).rowsBetween(W.unboundedPreceding, -1)
    totals = totals.select(
        _PART,
        *keys,
        *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_p_{new}") for new in sums],
    )
    # Groups of this window are single partitions of the range sort.
    inside = W.partitionBy(_PART, *keys).orderBy(_INDEX).rowsBetween(W.unboundedPreceding, 0)
    local = ranged.select("*", *[F.sum(src).over(inside).alias(f"_r_{new}") for new, src in sums.items()])
    return local.join(*_same_piece(totals if keys else F.broadcast(totals), keys)).select(
        *df.columns, *[(F.col(f"_r_{new}") + F.col(f"_p_{new}")).alias(new) for new in sums])
