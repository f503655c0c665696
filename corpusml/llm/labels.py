"""Labelled rows for the trained filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Share of ids that training never sees: one in five, by checksum.
FOLDS = 5


def held_out(idx: Column | str) -> Column:
    """Whether training never sees an id; a null id has no label and is not held out."""
    return F.coalesce(F.crc32(F.col(idx).cast("string") if isinstance(idx, str) else idx.cast("string")) % FOLDS == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, idx: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text, label)`` of at most ``rows`` labelled rows outside the held-out fold.

    The rows with the smallest hash of their id are taken, so the sample is the same on every run.
    Labels other than 0 and 1 are left out. The ids are at most ``rows``, which bounds the broadcast. Of rows
    that repeat an id the one with the smallest text is taken, so repeats do not add to the sample.
    """
    known = labels.select(F.col("doc_id").alias("_id"), F.col(label).cast("int").alias("label"))
    known = known.filter(F.col("label").isin(0, 1) & F.col("_id").isNotNull()).filter(~held_out("_id"))
    chosen = known.orderBy(F.xxhash64("_id"), "label").limit(rows)
    rows_of = docs.select(F.col(idx).alias("_doc"), F.col(text).alias("text"))
    found = rows_of.join(F.broadcast(chosen.distinct()), F.col("_doc") == F.col("_id"))
    return found.groupBy(F.col("_id").alias("doc_id"), "label").agg(F.min("text").alias("text")).select("doc_id", "text", "label")
