"""Shared pieces of the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.operators.rows import spread
from corpusml.session import ship_package

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Queries by name, with their reference SQL."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None):
        def register(query: Query) -> Query:
            self.queries[query.__name__] = query
            if sql is not None:
                self.sql[query.__name__] = sql
            return query

        return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(doc_id, labels, text)``: every document with its language and source as labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.array("lang", "source").alias("labels"), "text")
    return spread(docs, "doc_id")


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names labelled with their brand."""
    parts = table(spark, sf_dir, "part")
    return parts.select(F.col("p_partkey").alias("idx"), F.col("p_name").alias("entity"), F.array("p_brand").alias("labels"))


def more_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer names labelled with their market segment; a second view for vocabularies."""
    customers = table(spark, sf_dir, "customer")
    return customers.select(
        F.col("c_custkey").alias("idx"), F.col("c_name").alias("entity"), F.array("c_mktsegment").alias("labels")
    )


def places(value: Column | str, digits: int = 6) -> Column:
    """Round for comparison; adding zero turns a negative zero into zero."""
    value = F.col(value) if isinstance(value, str) else value
    return F.round(value, digits) + F.lit(0.0)


# SQL fragments -----------------------------------------------------------------------------

# Documents exploded to (doc_id, label, text).
SQL_DOC_LABELS = "SELECT doc_id, unnest([lang, source]) AS label, text FROM documents"


def sql_digest(text: str, digits: int = 8) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, {digits}) AS BIGINT)"


def sql_stop_words() -> str:
    from corpusml.functions.text import ENGLISH_STOP_WORDS

    return ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)


def sql_places(expression: str, digits: int = 6) -> str:
    return f"round({expression}, {digits}) + 0.0"
