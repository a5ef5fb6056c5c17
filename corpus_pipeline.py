"""The corpus pipeline: language ID, near-duplicates, secret scans, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage before kept. All but the last
return the columns of ``documents``; the last returns the places of the pieces in their sequences. Nulls
in any column, empty and very long texts, repeated rows and empty tables go through every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightloom.llm import langid, mixing, near_dedup, packing, secrets
from brightloom.llm.common import release_shuffles, small_batches, table, written
from brightloom.plans.registry import query

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A document goes if no language holds at least this share of it.
LEAST_SHARE = 0.4


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognised main language go; a missing ``lang`` is filled in."""
    small_batches(spark)
    found = langid.identify(docs.select(*COLUMNS), langid.fit(docs), out="_language")
    kept = found.filter((F.col("_language.lang") != langid.UNKNOWN) & (F.col("_language.score") >= LEAST_SHARE))
    return kept.withColumn("lang", F.coalesce("lang", "_language.lang")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: word shingles of five words, similarity of 0.8 or more."""
    small_batches(spark)
    marked = near_dedup.near_duplicates(docs)
    kept = written(marked.filter(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct(), "kept")
    stay = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return stay.unionByName(docs.filter(F.col("doc_id").isNull())).select(*COLUMNS)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark and ``n_chars`` follows; every document stays."""
    small_batches(spark)
    clean = secrets.redact(docs, secrets.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once, or up to three times."""
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64("text").cast("string"))
    keyed = docs.withColumn("_key", key)
    copies = mixing.mix(keyed, doc_id="_key").filter("copies > 0").groupBy("doc_id").agg(F.max("copies").cast("int").alias("_copies"))
    taken = keyed.join(written(copies.withColumnRenamed("doc_id", "_key"), "copies"), "_key")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences of at most 4096 tokens."""
    small_batches(spark)
    return packing.pack(docs, str(public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language ID", identify_language),
    ("near-duplicates", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: Trained models, registers and tokenizers have no SQL; the tests hold every stage against brute force.
ORACLE_SQL = None


@query("pipeline", ORACLE_SQL)
def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        release_shuffles(spark)
    return STAGES[-1][1](spark, docs, sf_dir)
