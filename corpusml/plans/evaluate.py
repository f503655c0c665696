"""Measures of predictions against true labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_label(scores: Column | str) -> Column:
    """The label of the highest ``(label, p)`` entry; ties go to the smaller label."""
    keyed = F.transform(scores, lambda s: F.struct((-s["p"]).alias("key"), s["label"].alias("label")))
    return F.array_min(keyed)["label"]


def accuracy(predictions: DataFrame, docs: DataFrame) -> DataFrame:
    """One row ``(documents, correct, accuracy)``; a prediction counts if it is among the labels.

    All documents count, also those without a prediction. A document has one prediction.
    """
    joined = docs.select("doc_id", "labels").join(predictions.select("doc_id", "label"), "doc_id", "left")
    hit = F.coalesce(F.array_contains("labels", F.col("label")), F.lit(False)).cast("long")
    return joined.agg(
        F.count(F.lit(1)).alias("documents"), F.sum(hit).alias("correct"), F.avg(hit).alias("accuracy")
    )
