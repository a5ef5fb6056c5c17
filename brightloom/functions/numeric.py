"""Number expressions: classes, bins, densities, distances, primes."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

# Age classes as (above, up to and including, name). Ages outside
# every class (so also 40, 50, 60 and 70) belong to AGE_REST.
AGE_CLASSES = [(40, 49, "40_49"), (50, 59, "50_59"), (60, 69, "60_69"), (70, None, "70_above")]
AGE_REST = "below_40"


def bin_by_bounds(value: Column, classes=AGE_CLASSES, rest: str = AGE_REST) -> Column:
    """Name of the class whose bounds hold ``value``; null counts as outside every class."""
    out = F.lit(rest)
    for above, top, name in classes:
        inside = value > above if top is None else (value > above) & (value <= top)
        out = F.when(inside, F.lit(name)).otherwise(out)
    return out


def round_to_class(prediction: Column, top: int = 3) -> Column:
    """Nearest class 0..top of a predicted number; halves go up, larger predictions to ``top``."""
    return F.greatest(F.lit(0), F.least(F.lit(top), F.floor(prediction + 0.5))).cast("bigint")


def fahrenheit_to_celsius(f: Column) -> Column:
    return (f - 32) * 5 / 9


def recode(value: Column, mapping: Mapping) -> Column:
    """Replace values by ``mapping``; values not listed become null."""
    out = F.lit(None)
    for old, new in mapping.items():
        out = F.when(value == F.lit(old), F.lit(new)).otherwise(out)
    return out


def normal_density(x: Column, mean: Column, std: Column) -> Column:
    """Density of the normal distribution."""
    return F.exp(-F.pow((x - mean) / std, 2) / 2) / (std * math.sqrt(2 * math.pi))


def euclidean(a: Column, b: Column) -> Column:
    """Straight-line distance of two number arrays."""
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, d: s + d))


def manhattan(a: Column, b: Column) -> Column:
    """Sum of absolute differences of two number arrays."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda s, d: s + d)


def _base_primes(most: int) -> Iterator[np.ndarray]:
    """The primes up to ``most`` in runs of bounded length, each sieved by the primes before it."""
    low, known = 2, np.zeros(0, np.int64)
    while low <= most:
        high = min(most, max(low * low - 1, 3), low + (1 << 20))
        whole = np.ones(high - low + 1, dtype=bool)
        for p in known[known <= math.isqrt(high)].tolist():
            whole[max(p * p, -(-low // p) * p) - low::p] = False
        found = np.flatnonzero(whole) + low
        known = np.concatenate([known, found[found < 1 << 16]])  # enough for runs below 2 ** 32, the root of a long
        yield found
        low = high + 1


def prime_mask(values: np.ndarray) -> np.ndarray:
    """Which whole numbers are prime: the range they span is sieved where it is short, else each is divided by all primes to its root.

    Works on whole arrays; memory follows from the number of values.
    """
    values = np.asarray(values, dtype=np.int64)
    prime = values >= 2
    if not prime.any():
        return prime
    low, high = int(values[prime].min()), int(values[prime].max())
    root = math.isqrt(high)
    if high - low < max(1 << 16, 8 * len(values)):
        whole = np.ones(high - low + 1, dtype=bool)
        for run in _base_primes(root):
            for p in run.tolist():
                whole[max(p * p, -(-low // p) * p) - low::p] = False
        prime[prime] = whole[values[prime] - low]
        return prime
    for run in _base_primes(root):
        for p in run.tolist():
            prime &= (values % p != 0) | (values == p)
    return prime


def array_predicate(test: Callable[[np.ndarray], np.ndarray]):
    """Any Python test on arrays as a condition on a column; null is false."""
    @F.pandas_udf(T.BooleanType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            out = np.zeros(len(values), dtype=bool)
            present = values.notna().to_numpy()
            if present.any():
                out[present] = test(values[present].to_numpy())
            yield pd.Series(out)

    return run


def typed_scalar(fn, result_type: T.DataType):
    """Wrap ``fn(series) -> series`` as a column function where no expression exists."""
    return F.pandas_udf(fn, result_type)
