"""The registered queries ``opN_<name>`` and the SQL of those that SQL can state."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from brightloom.llm import html_text, langid, licenses, merkle, mixing, near_dedup, neighbours, packing, prefixes, quality, secrets, substrings, warc
from brightloom.plans.registry import query, table


@query("op1_quality_rules", quality.check_sql())
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
               "n_stop_words", "n_lines", "n_open_lines", "n_bullet_lines")
    judged = quality.quality(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *[F.col("quality")[c].alias(c) for c in columns])


@query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select(
        "doc_id", langid.held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))


@query("op10_mixing", mixing.check_sql())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query("op8_secret_scans")
def op8_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, by pattern and by the tagged words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs, secrets.fit(docs))
    return found.select("doc_id", *secrets.digest(F.col("secrets")))


@query("op4_packing")
def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all documents in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), str(public_tokenizers.path("word_bpe_49k.json")))


@query("op6_near_duplicates")
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents linked by word triples, at a similarity of 0.85 or more."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query("op9_substring_dedup")
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that an earlier document holds in a string of 50 bytes."""
    return substrings.dedup(table(spark, sf_dir, "documents")).drop("kept")


@query("op5_html_text")
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op3_nearest_vectors")
def op3_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors of every hundredth vector."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op2_license_scans", licenses.check_sql())
def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License statements that documents hold."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op11_merkle_manifest", merkle.check_sql())
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and the root that its version has after tampering."""
    found = merkle.check(table(spark, sf_dir, "documents"))
    proof = F.sha2(F.array_join("siblings", "").cast("binary"), 256)
    return found.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof.alias("proof_sha256"),
        F.col("version_root").alias("folded_root"), (F.col("version_root") == F.col("root")).alias("verified"))


@query("op12_warc", warc.check_sql())
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as read back from the archives it was written to."""
    read = warc.archived_pages(table(spark, sf_dir, "pages"))
    return read.select(
        F.col("page_id").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"))


@query("op13_prefix_trie", prefixes.check_sql())
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    return prefixes.trie(table(spark, sf_dir, "conversations"))
