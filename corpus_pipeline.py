"""Pipeline from raw documents to a training mix.

Every stage takes ``(spark, docs, sf_dir)`` and returns a frame, which is written to the shared folder and
read again as the next stage's documents. All but the last keep the columns of the documents.

1. toxicity: documents that the classifier rejects go.
2. near-duplicates (five words, similarity 0.8): one document of each component stays.
3. benchmark decontamination: contaminated documents go.
4. secrets: base spans and live-looking spans of one owner are replaced by a mark.
5. mixing: sources get their target words; documents that the mix does not take go, the others say
   how often they are repeated.

Nulls, empty texts and extra columns pass through; rows without an id have no near-duplicates; of rows
that repeat id and text one stays at the second stage, other texts of an id that stays go on with it; empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.llm import decontamination, mixing, near_dedup, secrets, toxicity
from corpusml.queries.base import Catalog, table
from corpusml.storage import materialize

SHINGLE = 5
PERCENT = 80


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the toxicity classifier lets pass."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones: the one with the smallest id."""
    judged = near_dedup.near_duplicates(docs, k=SHINGLE, percent=PERCENT)
    kept = judged.filter("kept").select(F.col("doc_id").alias("__id")).distinct()
    named = docs.join(kept, F.col("doc_id") == F.col("__id"), "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(docs.filter("doc_id IS NULL"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that hold no benchmark item."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by a mark and ``n_chars`` of those counted again."""
    found = secrets.scan(docs).filter(F.size("spans") > 0)
    # Rows that repeat id and text have the same spans.
    found = found.select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans")).dropDuplicates(["__id", "__hash"])
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    marked = docs.join(found, same, "left")
    redacted = F.when(F.col("__spans").isNotNull(), secrets.redact(F.col("text"), F.col("__spans"))).otherwise(F.col("text"))
    # In a step of its own: inside one select, lambdas would take the new text for the old one.
    marked = marked.withColumn("__text", redacted)
    n_chars = F.when(F.col("__spans").isNotNull(), F.length("__text").cast("long")).otherwise(F.col("n_chars"))
    return marked.select(*[{"text": F.col("__text"), "n_chars": n_chars}.get(c, F.col(c)).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with ``mix_size``, ``mix_target``, ``mix_copies`` and ``mix_taken``.

    Rows that repeat id and text become one, with the copies of all of them.
    """
    added = ("size", "target", "copies", "taken")
    keys = ["__id", "__no_id", "__source", "__no_source", "__hash"]

    def keyed(df: DataFrame, text_hash: Column) -> DataFrame:
        # Never null, so that one shuffle of the texts serves both the repeats and the join.
        return df.withColumns({
            "__id": F.coalesce("doc_id", F.lit(0).cast("long")), "__no_id": F.isnull("doc_id"),
            "__source": F.coalesce("source", F.lit("")), "__no_source": F.isnull("source"), "__hash": text_hash,
        })

    mixed = keyed(mixing.mix(docs).filter("copies > 0"), F.col("text_hash")).groupBy(*keys).agg(
        F.max("size").alias("mix_size"), F.max("target").alias("mix_target"), F.sum("copies").alias("mix_copies"), F.sum("taken").alias("mix_taken")
    )
    known = keyed(docs.drop(*[f"mix_{c}" for c in added]), F.xxhash64("text")).dropDuplicates(keys)
    return known.join(mixed, keys).drop(*keys)


STAGES = [
    ("toxicity", reject_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
]

#: The first stage is learned from labels, which SQL cannot express.
ORACLE_SQL = None

catalog = Catalog()


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


@catalog.add(ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training mix out of all documents."""
    return run(spark, sf_dir)
