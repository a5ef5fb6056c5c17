"""Counts, tables of counts, descriptive statistics and information measures.

Where a result could hold one large list per key, it comes in long form or in
blocks of bounded length, so that no group has to fit into one task.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from brightloom.operators.columns import stacked
from brightloom.operators.positions import with_group_position, with_running_sums
from brightloom.session import checkpointed


def group_average(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Average per group, largest first; ties in key order."""
    return df.groupBy(*keys).agg(F.avg(value).alias(name)).orderBy(F.desc(name), *keys)


def posting_blocks(df: DataFrame, key: str, value: str, block: int = 1000) -> DataFrame:
    """Sorted distinct values per key as lists of at most ``block`` entries, numbered from 0.

    A key with few values has one list, block 0. A hot key has many blocks, built by
    many tasks; joining them in block order gives its whole list.
    """
    pairs = df.select(key, value).distinct()
    placed = with_group_position(pairs, [key], [value], "_at")
    return (
        placed.withColumn("block", F.floor(F.col("_at") / block))
        .groupBy(key, "block")
        .agg(F.array_sort(F.collect_list(value)).alias("values"))
    )


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in ``order``. The minimum is taken before the shuffle as well."""
    others = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_best"))
    return best.select(*keys, "_best.*").select(*df.columns)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Frequency of every value of several columns, long form."""
    return stacked(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The distinct non-null values of several columns, long form."""
    return stacked(df, columns).filter(F.col("value").isNotNull()).distinct()


def cross_table(df: DataFrame, row: str, column: str, values: Sequence) -> DataFrame:
    """Counts with one column per given value of ``column``, zero where a pair does not occur."""
    return df.groupBy(row).agg(
        *[F.count_if(F.col(column) == F.lit(v)).alias(f"{column}_{v}") for v in values])


def cross_table_margins(df: DataFrame, row: str, column: str, total: str = "All") -> DataFrame:
    """Counts of value pairs with row, column and grand totals under the name ``total``."""
    def named(c: str) -> Column:
        return F.when(F.grouping(c) == 1, F.lit(total)).otherwise(F.col(c).cast("string"))

    return df.cube(row, column).agg(
        named(row).alias("_row"), named(column).alias("_column"), F.count("*").alias("n")
    ).select(F.col("_row").alias(row), F.col("_column").alias(column), "n")


def null_counts(df: DataFrame) -> DataFrame:
    """Number of nulls of each column, one row."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def corrected_skewness(column: Column) -> Column:
    """Skewness with the small-sample correction; null below three values."""
    n = F.count(column).cast("double")
    return F.when(n > 2, F.skewness(column) * F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0)))


def _bracket(column: Column, accuracy: int) -> Column:
    """A sketch of two values that the median lies between."""
    margin = 2.0 / accuracy
    return F.percentile_approx(column, [0.5 - margin, 0.5 + margin], accuracy)


def medians(
    df: DataFrame, columns: Sequence[str], accuracy: int = 10_000, brackets: Mapping[str, Sequence[float] | None] | None = None
) -> DataFrame:
    """Exact median of each column: (column, median).

    Mergeable sketches first bracket each median between two values (``brackets``, where they are known); only
    the values inside the brackets, about 4/accuracy of the rows, are then counted and sorted. The
    exact counts below and inside a bracket are checked, and a column whose bracket does
    not hold its median is done over its whole range.
    """
    x = {c: F.col(c).cast("double") for c in columns}
    if brackets is None:
        brackets = df.agg(*[_bracket(x[c], accuracy).alias(c) for c in columns]).first().asDict()
    bounds = {c: brackets[c] for c in columns if brackets[c] is not None}
    if not bounds:
        return df.sparkSession.createDataFrame([], "column string, median double")
    sizes = df.agg(*[
        expression.alias(f"{c}_{name}") for c, (low, high) in bounds.items() for name, expression in (
            ("n", F.count(x[c])), ("below", F.count_if(x[c] < low)), ("inside", F.count_if(x[c].between(low, high))))
    ]).first()

    wanted, inside = [], {}
    for c, (low, high) in bounds.items():
        n, below = sizes[f"{c}_n"], sizes[f"{c}_below"]
        first, last = (n + 1) // 2, n // 2 + 1
        if below < first and last <= below + sizes[f"{c}_inside"]:
            inside[c] = F.when(x[c].between(low, high), x[c])
        else:
            below, inside[c] = 0, x[c]
        wanted.append((c, first - below, last - below))

    cells = [F.struct(F.lit(c).alias("column"), v.alias("value")) for c, v in inside.items()]
    values = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    # Checkpointed: the sort reads its input twice, and it is far smaller than the table.
    counted = checkpointed(values.groupBy("column", "value").agg(F.count("*").alias("n")))
    ranked = with_running_sums(counted, ["value"], {"up_to": "n"}, keys=["column"])
    # One row per column of the table.
    places = F.broadcast(df.sparkSession.createDataFrame(wanted, "column string, first bigint, last bigint"))
    middle = ranked.join(places, "column").filter(
        (F.col("up_to") >= F.col("first")) & (F.col("up_to") - F.col("n") < F.col("last")))
    return middle.groupBy("column").agg(((F.min("value") + F.max("value")) / 2).alias("median"))


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, median, variance, minimum, maximum, deviation and corrected skewness per column; one pass gives all but the median."""
    accuracy = 10_000

    def one(c: str) -> Column:
        x = F.col(c).cast("double")
        return F.struct(
            F.lit(c).alias("column"), F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_samp(x).alias("variance"),
            F.min(x).alias("min"), F.max(x).alias("max"), F.stddev_samp(x).alias("std"),
            corrected_skewness(x).alias("skew"), _bracket(x, accuracy).alias("bracket"))

    moments = checkpointed(df.agg(F.array(*[one(c) for c in columns]).alias("s")).select(F.inline("s")))
    brackets = {r["column"]: r["bracket"] for r in moments.collect()}  # one row a column
    return moments.drop("bracket").join(medians(df, columns, accuracy, brackets), "column", "left")


def moments_by_class(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of numeric columns, per class and over all rows (class null)."""
    aggregates = [
        f(F.col(c)).alias(f"{c}_{name}") for c in columns for name, f in (("mean", F.avg), ("std", F.stddev_samp))
    ]
    return df.rollup(label).agg(*aggregates)


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Sample covariance of every column pair in one pass: (a, b, covariance)."""
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.covar_samp(a, b).alias("covariance"))
        for a in columns for b in columns
    ]
    return df.agg(F.array(*cells).alias("m")).select(F.inline("m"))


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact number of distinct non-null values of each column, in one pass over (column, value hash) pairs: (column, n_distinct).

    Values are told apart by 128 bits of hash; repeats go before the shuffle.
    """
    cells = [
        F.struct(F.lit(c).alias("column"), F.xxhash64(F.col(c)).alias("h"), F.xxhash64(F.col(c), F.lit(c), F.lit(1)).alias("g"), F.col(c).isNotNull().alias("known"))
        for c in columns]
    values = df.select(F.inline(F.array(*cells))).filter("known").groupBy("column", "h", "g").agg(F.lit(1).alias("_one"))
    return values.groupBy("column").agg(F.count("*").alias("n_distinct"))


def _sketched(c: str, kind: str, size: int) -> Column:
    value = F.col(c) if kind in ("int", "bigint", "string", "binary") else F.col(c).cast("string")
    return F.coalesce(F.hll_sketch_estimate(F.hll_sketch_agg(value, size)), F.lit(0).cast("bigint"))


def profile(df: DataFrame, target: str | None = None, sketch: int | None = None) -> DataFrame:
    """One row per column: type, rows, non-null and distinct counts, smallest and largest value.

    With a 0/1 ``target`` also its mean over the rows where the column is present. Distinct values are
    counted exactly, or with ``sketch`` (4 to 21) by mergeable sketches of ``2 ** sketch`` registers in the same
    single row as all the rest, with a relative deviation of about ``1.04 / 2 ** (sketch / 2)``.
    """
    kinds = dict(df.dtypes)

    def one(c: str) -> Column:
        fields = [
            F.lit(c).alias("column"), F.lit(kinds[c]).alias("type"), F.count("*").alias("n_rows"), F.count(c).alias("n_present"),
            F.min(c).cast("string").alias("smallest"), F.max(c).cast("string").alias("largest"),
        ]
        if target:
            fields.append(F.avg(F.when(F.col(c).isNotNull(), F.col(target))).alias("target_rate"))
        if sketch:
            fields.append(_sketched(c, kinds[c], sketch).alias("n_distinct"))
        return F.struct(*fields)

    rows = df.agg(F.array(*[one(c) for c in df.columns]).alias("p")).select(F.inline("p"))
    if not sketch:
        rows = rows.join(distinct_counts(df, df.columns), "column", "left").withColumn(
            "n_distinct", F.coalesce("n_distinct", F.lit(0).cast("bigint")))
    names = ["column", "type", "n_rows", "n_present", "n_distinct", "smallest", "largest"]
    return rows.select(*names, *["target_rate"] * bool(target))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal bins between minimum and maximum, empty ones too; the top value counts in the last bin."""
    x = F.col(column).cast("double")
    low, high = df.agg(F.min(x), F.max(x)).first()
    if low is None:
        return df.sparkSession.createDataFrame([], "bin bigint, low double, n bigint")
    width = (high - low) / bins or 1.0
    number = F.least(F.floor((x - F.lit(low)) / F.lit(width)), F.lit(bins - 1)).cast("bigint")
    counts = df.filter(x.isNotNull()).groupBy(number.alias("bin")).agg(F.count("*").alias("n"))
    every = df.sparkSession.range(bins).withColumnRenamed("id", "bin").join(counts, "bin", "left")
    return every.select(
        "bin", (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"), F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def class_priors(df: DataFrame, label: str) -> DataFrame:
    """Share of each class."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.select(label, "n", (F.col("n") / counts.agg(F.sum("n")).scalar()).alias("prior"))


def _plogp(count: Column, log) -> Column:
    return F.when(count > 0, count * log(count.cast("double"))).otherwise(0.0)


def entropy(df: DataFrame, column: str) -> DataFrame:
    """Entropy of a column in bits, from its value counts."""
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    total = F.sum("n")
    return counts.agg((F.log2(total.cast("double")) - F.sum(_plogp(F.col("n"), F.log2)) / total).alias("entropy"))


def _attribute_counts(df: DataFrame, attributes: Mapping[str, Column], target: str) -> DataFrame:
    """(attribute, value, target, n) for several attributes in one pass over the rows."""
    cells = [F.struct(F.lit(name).alias("attribute"), c.cast("string").alias("value")) for name, c in attributes.items()]
    long = df.select(F.col(target).alias("target"), F.explode(F.array(*cells)).alias("a")).select("target", "a.*")
    return long.groupBy("attribute", "value", "target").agg(F.count("*").alias("n"))


def information_gain(df: DataFrame, attributes: Mapping[str, Column] | Sequence[str], target: str) -> DataFrame:
    """Entropy of the target minus its entropy within each value of the attribute, in bits.

    Give a boolean expression as attribute for the gain of one value against the rest.
    """
    if not isinstance(attributes, Mapping):
        attributes = {name: F.col(name) for name in attributes}
    joint = _attribute_counts(df, attributes, target)
    by_value = joint.groupBy("attribute", "value").agg(
        F.sum("n").alias("n"), F.sum(_plogp(F.col("n"), F.log2)).alias("inner"))
    by_target = joint.groupBy("attribute", "target").agg(F.sum("n").alias("n")).groupBy("attribute").agg(
        (F.log2(F.sum("n").cast("double")) - F.sum(_plogp(F.col("n"), F.log2)) / F.sum("n")).alias("target_entropy"))
    within = by_value.groupBy("attribute").agg(
        ((F.sum(_plogp(F.col("n"), F.log2)) - F.sum("inner")) / F.sum("n")).alias("conditional_entropy"))
    return within.join(by_target, "attribute").select(
        "attribute", (F.col("target_entropy") - F.col("conditional_entropy")).alias("gain"))


def mutual_information(df: DataFrame, attributes: Sequence[str], target: str) -> DataFrame:
    """Mutual information of discrete attributes with the target, in nats."""
    gains = information_gain(df, attributes, target)
    return gains.select("attribute", (F.col("gain") * math.log(2)).alias("mutual_information"))


def best_row(df: DataFrame, metric: str, key: str, smallest: bool = True) -> DataFrame:
    """The key with the best metric; ties go to the smallest key."""
    order = F.struct(F.col(metric) if smallest else -F.col(metric), F.col(key))
    return df.agg(F.min_by(key, order).alias(key), F.min_by(metric, order).alias(metric))


def metric_rows(results: Mapping[tuple[str, str], DataFrame]) -> DataFrame:
    """One long table (model, dataset, metric, value) from one-row metric tables."""
    parts = []
    for (model, dataset), df in results.items():
        names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
        pairs = ", ".join(f"'{n}', CAST(`{n}` AS DOUBLE)" for n in names)
        parts.append(df.selectExpr(
            f"'{model}' AS model", f"'{dataset}' AS dataset", f"stack({len(names)}, {pairs}) AS (metric, value)"))
    return reduce(DataFrame.unionByName, parts)
