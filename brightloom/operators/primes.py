"""Rows with a prime key, by a sieve over the ranges of keys that occur."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from brightloom.functions.numeric import prime_mask
from brightloom.operators.skew import salted_join


def with_prime_key(df: DataFrame, key: str, spread: Sequence[str]) -> DataFrame:
    """The rows whose whole-number ``key`` is prime; null is not.

    Distinct keys are range-sorted, so a batch spans a short range and is sieved at once, or divided by the
    primes up to its root where the keys lie far apart. The primes found are joined to the rows; rows of a
    hot key are dealt over tasks by the columns ``spread``.
    """
    kind = dict(df.dtypes)[key]

    def sieved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for keys in batches:
            yield keys[prime_mask(keys[key].to_numpy())]

    keys = df.select(key).filter(F.col(key) >= 2).distinct()
    primes = keys.repartitionByRange(key).sortWithinPartitions(key).mapInPandas(sieved, f"`{key}` {kind}")
    return salted_join(df, primes, [key], spread, "left_semi")
