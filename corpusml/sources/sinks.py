"""Writers of the text formats the jobs exchange."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_lines(df: DataFrame, line: Column, path: str) -> None:
    """Store one formatted line per row, without any quoting."""
    df.select(line.alias("value")).write.mode("overwrite").text(path)


def show_rows(df: DataFrame):
    """Iterate over every row of a result, one partition at a time."""
    return df.toLocalIterator()


def write_labelled(docs: DataFrame, path: str) -> None:
    """``doc_id \\t labels \\t text``; tabs and line ends inside the text become spaces."""
    clean = F.translate("text", "\t\n\r", "   ")
    write_lines(docs, F.concat_ws("\t", F.col("doc_id").cast("string"), F.array_join("labels", ","), clean), path)


def write_counters(counters: DataFrame, path: str) -> None:
    """``key \\t n`` lines from the typed rows of ``roll_up_counters``."""
    label, word = F.col("label"), F.col("word")
    key = (
        F.when(F.col("level") == "label_word", F.concat(F.lit("Y="), label, F.lit(",W="), word))
        .when(F.col("level") == "label_words", F.concat(F.lit("Y="), label, F.lit(",W=*")))
        .when(F.col("level") == "label", F.concat(F.lit("Y="), label))
        .otherwise(F.lit("Y=*"))
    )
    write_lines(counters, F.concat_ws("\t", key, F.col("n").cast("string")), path)


def write_top_words(top: DataFrame, path: str) -> None:
    """``label \\t word \\t n`` lines."""
    write_lines(top, F.concat_ws("\t", "label", "word", F.col("n").cast("string")), path)


def prediction_line(scores: Column | str = "scores") -> Column:
    """``label \\t p,label \\t p,…`` from an array of ``(label, p)``."""
    return F.array_join(F.transform(scores, lambda s: F.concat_ws("\t", s["label"], s["p"].cast("string"))), ",")


def word_topic_lines(word_topics: DataFrame, topics: int, num_words: int) -> DataFrame:
    """One row per word id from 0 to ``num_words - 1``: its counts of topics 0 … K-1, absent ones as 0.

    The line number stands for the word id, so a word that does not occur has a line of zeros.
    """
    counts = [F.sum(F.when(F.col("topic") == k, F.col("n")).otherwise(0)).cast("string") for k in range(topics)]
    found = word_topics.groupBy(F.col("word_id").cast("long").alias("word_id")).agg(F.concat_ws(",", *counts).alias("line"))
    every = word_topics.sparkSession.range(num_words).withColumnRenamed("id", "word_id")
    zeros = F.lit(",".join(["0"] * topics))
    return every.join(found, "word_id", "left").select("word_id", F.coalesce("line", zeros).alias("line"))


def write_word_topics(word_topics: DataFrame, topics: int, path: str, num_words: int) -> None:
    """The word-by-topic table as text, in order of word id, one line for each of ``num_words`` ids."""
    ordered = word_topic_lines(word_topics, topics, num_words).orderBy("word_id")
    write_lines(ordered, F.col("line"), path)


def write_likelihood(history: DataFrame, path: str) -> None:
    """``iteration,seconds,likelihood`` lines."""
    write_lines(history.orderBy("iteration"), F.concat_ws(",", *[F.col(c).cast("string") for c in ("iteration", "seconds", "likelihood")]), path)


def write_topic_words(topic_words: DataFrame, path: str) -> None:
    """``topic,word,word,…`` lines."""
    write_lines(topic_words.orderBy("topic"), F.concat_ws(",", F.col("topic").cast("string"), F.array_join("words", ",")), path)


def write_probabilities(scored: DataFrame, path: str) -> None:
    """``(idx, probs)`` as parquet, in order of ``idx``."""
    scored.select("idx", "probs").orderBy("idx").write.mode("overwrite").parquet(path)
