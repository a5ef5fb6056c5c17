"""Missing values, types and row rules on whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

# The ways a missing field is written.
SENTINELS = ["", "\\N", "not in universe"]


def sentinels_to_null(df: DataFrame, columns: Sequence[str] | None = None, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """Turn written-out missing values into nulls, in string columns unless named."""
    columns = columns or columns_of_type(df, T.StringType)
    return df.withColumns({c: F.when(~F.col(c).isin(list(sentinels)), F.col(c)) for c in columns})


def columns_of_type(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    """Names of the columns of the given types, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def rule_nested(conditions: Sequence[Column]) -> Column:
    """1 where all conditions hold, written as one decision inside the other; a condition that is null does not hold."""
    out = F.lit(1)
    for c in reversed(conditions):
        out = F.when(c, out).otherwise(0)
    return out


def rule_flat(conditions: Sequence[Column]) -> Column:
    """The same rule as one condition; null where one is null and none is false."""
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out.cast("int")


def stacked(df: DataFrame, columns: Sequence[str], name: str = "column", value: str = "value") -> DataFrame:
    """Long form (name, value as string) of several columns."""
    pairs = ", ".join(f"'{c}', CAST(`{c}` AS STRING)" for c in columns)
    return df.selectExpr(f"stack({len(columns)}, {pairs}) AS ({name}, {value})")
