"""Joins on keys of which a few hold a large part of all rows.

Heavy keys are found by a mergeable sketch in one pass without a shuffle. Their rows are dealt over pieces,
and the rows of the other side, few for each key, are repeated for every piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

_PIECE = "_piece"


def key_hash(columns: Sequence[str | Column]) -> Column:
    """One number for a key; keys that share it are only dealt over pieces together."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in columns])


def hot_keys(df: DataFrame, keys: Sequence[str | Column], share: float = 0.01, tracked: int = 10_000) -> list[int]:
    """Hashes of all keys that hold at least ``share`` of the rows, at most ``2 / share`` of them.

    The sketch counts ``tracked`` keys with an error of about 3.5 rows in ``tracked``, so keys from half of
    ``share`` on are taken, and none with a full share is missed.
    """
    most = int(2 / share)
    if tracked < 8 / share:
        raise ValueError("the sketch is too small for this share")
    top = df.select(key_hash(keys).alias("key")).agg(F.expr(f"approx_top_k(key, {most}, {tracked})").alias("top"), F.count("*").alias("n")).first()
    return [item["item"] for item in top["top"] or [] if item["count"] >= share * top["n"] / 2]


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], spread: Sequence[str], how: str = "inner",
    pieces: int = 64, share: float = 0.01, hot: Sequence[int] | None = None,
) -> DataFrame:
    """``left`` joined to the few rows that ``right`` has for each key; null keys meet nothing.

    Rows of hot keys on the left are dealt over ``pieces`` by a hash of the columns ``spread``, which should
    tell them apart; rows alike in them stay together. ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how}: the right side is repeated, so its rows can't be kept")
    hot = hot_keys(left, keys, share) if hot is None else list(hot)
    is_hot = key_hash(keys).isin(hot) if hot else F.lit(False)
    dealt = F.pmod(F.xxhash64(*spread), F.lit(pieces)).cast("int")
    apart = left.withColumn(_PIECE, F.when(is_hot, dealt).otherwise(0))
    repeated = right.withColumn(_PIECE, F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(pieces - 1))).otherwise(F.array(F.lit(0)))))
    return apart.join(repeated, [*keys, _PIECE], how).drop(_PIECE)
