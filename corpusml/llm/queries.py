"""The numbered queries, one for each operator, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusml.llm import alignment, clustering, decontamination, extraction, fingerprints, mixing, near_dedup, quality, secrets, substring_dedup, suffix_dedup, toxicity, warc
from corpusml.queries.base import Catalog, table

catalog = Catalog()


@catalog.add(mixing.OP_SQL)
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that every document gives to a mix of all sources."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@catalog.add(secrets.OP_SQL)
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with values of one owner told from copied examples."""
    return secrets.digest_columns(secrets.scan(table(spark, sf_dir, "documents")))


@catalog.add()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document from learned subword vectors."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@catalog.add()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document from words restored by a noisy-channel decoder."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@catalog.add(warc.OP_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archive records and read back through the index."""
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return warc.round_trip(table(spark, sf_dir, "pages")).select(*columns)


@catalog.add()
def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multiset fingerprints of every document and of its edited text."""
    return fingerprints.with_next(table(spark, sf_dir, "documents"))


@catalog.add()
def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain benchmark items, in whatever order of their parts."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@catalog.add(near_dedup.OP_SQL)
def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar shingle sets."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), k=4)


@catalog.add(suffix_dedup.OP_SQL)
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the byte strings that also start earlier."""
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@catalog.add(substring_dedup.OP_SQL)
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the word sequences that also start earlier."""
    return substring_dedup.without_repeats(table(spark, sf_dir, "documents")).drop("kept")


@catalog.add(clustering.OP_SQL)
def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with the nearest of 40 centroids after five rounds."""
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


@catalog.add()
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers, aligned by their ends."""
    return alignment.align(table(spark, sf_dir, "documents"))


@catalog.add()
def op11_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extraction.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")
