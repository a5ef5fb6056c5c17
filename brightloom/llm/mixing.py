"""Mixing sources to target weights by exponential keys and running word budgets."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from brightloom.llm.common import word_count, written
from brightloom.operators.positions import with_position, with_running_sums

#: Source weights, dealt to the sources in code-point order, again and again.
WEIGHTS = (1, 2, 3)
#: A source gives at most so many times its own size.
MOST_REPEATS = 3
#: Walks over the documents of a source: the first up to the budget, the others for what is left of it.
WALKS = 4


def quality_weight(text: Column, size: Column) -> Column:
    """Weight in (0, 1]: falls with the number of symbols for each word."""
    text = F.coalesce(text, F.lit(""))
    symbols = F.length(text) - F.length(F.regexp_replace(text, "[#*$%&|<>]+", ""))
    return F.when(size == 0, F.lit(1.0)).otherwise(size.cast("double") / (size + 4 * symbols).cast("double"))


def exponential_key(doc_id: Column, weight: Column) -> Column:
    """``-ln(u) / weight`` with ``u`` in (0, 1) fixed by the id: heavy documents tend to come first."""
    digits = F.substring(F.md5(F.concat(F.lit("mix"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 12)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def source_targets(sized: DataFrame, source: str, size: str, weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per source: its size, and its share of all sizes by weight, capped at ``most`` times its size.

    What the cap takes from one source is shared among the others by weight until no target is above its
    cap. With sources in the order of cap per weight this is a running sum: capped sources come first.
    """
    sources = sized.groupBy(source).agg(F.sum(size).alias("source_size"))
    placed = with_position(sources, [F.col(source).asc_nulls_last()], "_place")
    dealt = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    placed = placed.withColumn("_weight", dealt.cast("long")).withColumn("_cap", F.col("source_size") * most)
    ranked = with_running_sums(
        placed.withColumn("_ratio", F.col("_cap").cast("double") / F.col("_weight")),
        ["_ratio", "_place"], {"_caps": "_cap", "_weights": "_weight"})
    totals = placed.agg(F.sum("source_size").alias("_all"), F.sum("_weight").alias("_all_weights"))  # one row
    level = (F.col("_all") - F.col("_caps") + F.col("_cap")).cast("double") / (F.col("_all_weights") - F.col("_weights") + F.col("_weight"))
    ranked = ranked.join(F.broadcast(totals)).withColumn("_level", F.when(F.col("_ratio") > level, level))
    water = ranked.agg(F.max("_level").alias("_water"))  # one row
    return ranked.join(F.broadcast(water)).select(
        source, "source_size",
        F.least(F.col("_cap").cast("double"), F.col("_weight") * F.coalesce(F.col("_water"), F.lit(0.0))).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weights=WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """One row per document: ``doc_id, size, source, source_size, target, copies, taken``.

    Every document of a source is taken in each complete epoch that fits its target; the rest of
    the target goes to the documents with the smallest exponential keys, as long as they fit the word budget.
    What is then left of it goes in the same way to the later documents that are not larger than that, and so on
    in ``WALKS`` walks, so a target is missed by little even where a long document stands at the border. Sources
    that hold a large part of all rows are sorted over many tasks. A null text has size 0, a null source is a
    source, a null id counts as the empty text for its key; rows that are alike in id and size share one key
    and may be taken a different number of times; an empty table gives an empty one.
    """
    count = word_count(F.col(text))
    sized = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), count.alias("size"),
        exponential_key(F.col(doc_id), quality_weight(F.col(text), count)).alias("_key"))
    sized = written(sized, "sizes")  # far smaller than the texts, which are read once
    # One small row per source; Spark broadcasts it where its size allows.
    target = source_targets(sized, "source", "size", weights, most).withColumnRenamed("source", "_source")
    epochs = F.when(F.col("source_size") == 0, F.lit(0)).otherwise(F.floor(F.col("target") / F.col("source_size")))
    target = target.withColumn("_epochs", epochs.cast("long")).withColumn("_left", F.col("target") - F.col("_epochs") * F.col("source_size"))
    target = written(target, "targets")
    waiting, left, parts = sized, target.select("_source", "_left"), []
    for walk in range(WALKS):
        near = waiting.join(left, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        fits = (F.col("size") > 0) & (F.col("size") <= F.col("_left")) if walk else F.lit(True)
        run = with_running_sums(near.filter(fits), ["_key", "doc_id", "size"], {"_run": "size"}, keys=["source"])
        run = written(run.withColumn("_extra", (F.col("_run") <= F.col("_left")).cast("int")), "walk")
        rest = [near.filter(~fits).withColumn("_extra", F.lit(0)).drop("_left")] if walk else []
        parts.append(run.filter("_extra = 1").select("doc_id", "source", "size", "_extra"))
        waiting = reduce(DataFrame.unionByName, [run.filter("_extra = 0").drop("_run", "_left"), *rest]).drop("_extra")
        used = run.groupBy("source").agg(F.max(F.when(F.col("_extra") == 1, F.col("_run"))).alias("_used"))
        used = used.select(F.col("source").alias("_own"), F.coalesce("_used", F.lit(0)).alias("_used"))
        left = written(left.join(used, F.col("_source").eqNullSafe(F.col("_own")), "left").select(
            "_source", (F.col("_left") - F.coalesce("_used", F.lit(0))).alias("_left")), "left")
    parts.append(waiting.select("doc_id", "source", "size", F.lit(0).alias("_extra")))
    return (
        reduce(DataFrame.unionByName, parts).join(target, F.col("source").eqNullSafe(F.col("_source")))
        .withColumn("copies", F.least(F.col("_epochs") + F.col("_extra"), F.lit(most)).cast("long"))
        .select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken")))


def check_sql(weights=WEIGHTS, most: int = MOST_REPEATS) -> str:
    """The DuckDB statement for the query over ``documents``."""
    dealt = f"[{', '.join(map(str, weights))}]"

    def walk(i: int) -> str:
        fits = "size > 0 AND size <= rest" if i else "true"
        return f"""
r{i} AS MATERIALIZED (SELECT id, source, rest, size, sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
    FROM (SELECT w.*, rest FROM w{i} w JOIN l{i} l ON w.source IS NOT DISTINCT FROM l.source) WHERE {fits}),
t{i} AS MATERIALIZED (SELECT id, source, upto FROM r{i} WHERE upto <= rest),
w{i + 1} AS MATERIALIZED (SELECT * FROM w{i} WHERE id NOT IN (SELECT id FROM t{i})),
l{i + 1} AS MATERIALIZED (SELECT l.source, any_value(rest) - coalesce(max(upto), 0) AS rest FROM l{i} l
    LEFT JOIN t{i} t ON l.source IS NOT DISTINCT FROM t.source GROUP BY l.source)"""

    walks = ",".join(walk(i) for i in range(WALKS)) + ",\ntaken AS (" + " UNION ALL ".join(f"SELECT id FROM t{i}" for i in range(WALKS)) + ")"
    return f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t,
    len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+'))::BIGINT AS size FROM documents),
k AS (SELECT doc_id, source, size,
    CASE WHEN size = 0 THEN 1.0::DOUBLE ELSE size::DOUBLE / (size + 4 * length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')))::DOUBLE END AS w,
    (('0x' || substr(md5('mix' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0::DOUBLE AS u FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM k GROUP BY source),
p AS (SELECT *, {dealt}[1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(weights)}] AS w,
    row_number() OVER (ORDER BY source NULLS LAST) AS place FROM s),
r AS (SELECT *, source_size * {most} AS cap, (source_size * {most})::DOUBLE / w::DOUBLE AS ratio FROM p),
x AS (SELECT *, sum(source_size) OVER () AS everything, sum(w) OVER () AS weights,
    sum(cap) OVER (ORDER BY ratio, place) - cap AS caps_before, sum(w) OVER (ORDER BY ratio, place) - w AS weights_before FROM r),
y AS (SELECT *, (everything - caps_before)::DOUBLE / (weights - weights_before)::DOUBLE AS level FROM x),
z AS (SELECT source, source_size, least(cap::DOUBLE, w::DOUBLE * coalesce(max(CASE WHEN ratio > level THEN level END) OVER (), 0.0::DOUBLE)) AS target FROM y),
e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size)::BIGINT END AS epochs FROM z),
l0 AS (SELECT source, target - epochs * source_size AS rest FROM e),
w0 AS (SELECT row_number() OVER () AS id, doc_id, source, size, -ln(u) / w AS key FROM k),
{walks}
SELECT doc_id, size, source_size, target, (size * least(epochs + CASE WHEN id IN (SELECT id FROM taken) THEN 1 ELSE 0 END, {most}))::BIGINT AS taken
FROM w0 JOIN e ON w0.source IS NOT DISTINCT FROM e.source"""
