"""Readers of line-oriented text files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusml.functions.text import percent_decode
from corpusml.operators.ranking import file_rank


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line, without its line end: ``value string``."""
    return spark.read.text(path)


def numbered_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with their place: file, split within the file, and order within the split.

    Files are scanned in splits; rows keep file order within one split, so the increasing
    per-task id orders the lines of a split without a shuffle.
    """
    return spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"),
    )


def _field(i: int) -> Column:
    # Not the CSV reader: text may hold quote characters.
    return F.get(F.split("value", "\t"), F.lit(i))


def _labels() -> Column:
    return F.filter(F.split(_field(1), ","), lambda x: F.length(x) > 0)


def read_labelled(spark: SparkSession, path: str | list[str], numbered: bool = False) -> DataFrame:
    """Labelled documents, one per line: ``doc_id \\t label,label,… \\t text``.

    ``numbered`` adds ``idx``, the line number.
    """
    fields = [_field(0).alias("doc_id"), _labels().alias("labels"), _field(2).alias("text")]
    if not numbered:
        return read_lines(spark, path).select(*fields)
    lines = numbered_lines(spark, path).select(*fields, "path", "block", "position")
    return file_rank(lines).select("idx", "doc_id", "labels", "text")


def read_unlabelled(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The first and third field of the same files, for scoring."""
    return read_lines(spark, path).select(_field(0).alias("doc_id"), _field(2).alias("text"))


def read_entities(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Labelled entity names, one per line: ``idx long, entity string, labels array<string>``.

    Both fields are percent-encoded; ``idx`` is the line number.
    """
    lines = numbered_lines(spark, path).select(
        percent_decode(_field(0)).alias("entity"),
        F.split(percent_decode(_field(1)), ",").alias("labels"),
        "path", "block", "position",
    )
    return file_rank(lines).select("idx", "entity", "labels")


def read_id_lists(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Ragged comma-separated integers, one document per line: ``doc_id long, words array<int>``."""
    lines = numbered_lines(spark, path).select(
        F.split("value", ",").cast("array<int>").alias("words"), "path", "block", "position"
    )
    return file_rank(lines, "doc_id").select("doc_id", "words")


def with_part(df: DataFrame, idx: str, parts: int) -> DataFrame:
    """Add ``part``: the worker, of ``parts``, that a round-robin load gives a row to."""
    return df.withColumn("part", F.pmod(F.col(idx), F.lit(parts).cast("long")))


def take_part(df: DataFrame, idx: str, part: int, parts: int) -> DataFrame:
    """The rows that worker ``part`` loads: every ``parts``-th one."""
    return with_part(df, idx, parts).filter(F.col("part") == part).drop("part")


def distribute(df: DataFrame, idx: str, parts: int) -> DataFrame:
    """Spread all rows over ``parts`` partitions by their id."""
    return df.repartition(parts, idx)


def read_counters(spark: SparkSession, path: str) -> DataFrame:
    """``(label, word, n)`` rows from a ``Y=label,W=word \\t n`` counter file.

    Other levels of the file are left out, as only the word counters feed the top lists, and so are
    lines whose count is no number.
    """
    key = _field(0)
    pattern = r"^Y=(.*),W=(\w+)$"
    parsed = read_lines(spark, path).select(
        F.regexp_extract(key, pattern, 1).alias("label"),
        F.regexp_extract(key, pattern, 2).alias("word"),
        F.try_to_number(_field(1), F.lit("9999999999999999999")).cast("long").alias("n"),
    )
    return parsed.filter((F.col("word") != "") & F.col("n").isNotNull())


def read_word_topics(spark: SparkSession, path: str, topics: int | None = None) -> DataFrame:
    """``(word_id, topic, n)`` rows from a word-by-topic table, one line of counts per word.

    The number of topics is that of the line; a line with another number than ``topics`` is an error.
    """
    lines = numbered_lines(spark, path).select(F.split("value", ",").cast("array<bigint>").alias("counts"), "path", "block", "position")
    rows = file_rank(lines, "word_id")
    if topics is not None:
        wrong = F.raise_error(F.concat(F.lit(f"expected {topics} topics, found "), F.size("counts").cast("string")))
        rows = rows.withColumn("counts", F.when(F.size("counts") == topics, F.col("counts")).otherwise(wrong))
    return rows.select("word_id", F.posexplode("counts").alias("topic", "n"))


def read_vocabulary(spark: SparkSession, path: str) -> DataFrame:
    """``(word_id, word)`` from a file of one word per line."""
    lines = numbered_lines(spark, path).withColumnRenamed("value", "word")
    return file_rank(lines, "word_id").select("word_id", "word")
