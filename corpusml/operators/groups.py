"""Grouping: built-in reductions, whole groups in bounded pieces, folds and counter roll-ups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def reduce_groups(df: DataFrame, keys: list[str], **reductions: Column) -> DataFrame:
    """Reduce each group with built-in aggregates, which combine before the shuffle."""
    return df.groupBy(*keys).agg(*[agg.alias(name) for name, agg in reductions.items()])


def count_groups(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return reduce_groups(df, keys, **{name: F.count(F.lit(1))})


def sum_groups(df: DataFrame, keys: list[str], value: str, name: str = "total") -> DataFrame:
    return reduce_groups(df, keys, **{name: F.sum(value)})


def group_rows(df: DataFrame, keys: list[str], value: Column, piece_rows: int = 10_000) -> DataFrame:
    """Whole groups as lists: ``(keys, piece, pieces, items)``.

    A group of up to ``piece_rows`` rows is one list. A larger one comes in several pieces of
    about that many rows, numbered from 0, so that no task ever holds an unbounded group;
    together the pieces hold every row of the group. The list in each piece is sorted.
    """
    # Equal rows are counted first and a very frequent one is cut into parts, so pieces can be
    # dealt out by a hash of the content: the same on every attempt of a task.
    counted = df.select(*keys, value.alias("item")).groupBy(*keys, "item").agg(F.count(F.lit(1)).alias("copies"))
    sizes = counted.groupBy(*keys).agg(F.ceil(F.sum("copies") / piece_rows).alias("pieces"))
    parts = counted.withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / piece_rows).cast("int")))
    )
    matched = [parts[k].eqNullSafe(sizes[k]) for k in keys]
    pieced = parts.join(sizes, matched).select(
        *[parts[k] for k in keys],
        F.pmod(F.xxhash64("item", "part"), F.col("pieces")).alias("piece"),
        "pieces",
        F.array_repeat("item", F.least(F.lit(piece_rows), F.col("copies") - F.col("part") * piece_rows).cast("int")).alias("items"),
    )
    return pieced.groupBy(*keys, "piece", "pieces").agg(
        F.sort_array(F.flatten(F.collect_list("items"))).alias("items")
    )


def fold_groups(
    df: DataFrame,
    keys: list[str],
    value: Column,
    start: Column,
    step: Callable[[Column, Column], Column],
    merge: Callable[[Column, Column], Column],
    piece_rows: int = 10_000,
) -> DataFrame:
    """Reduce each group with a user fold that no built-in aggregate covers.

    ``step`` folds one value into the accumulator and ``merge`` joins two accumulators, so
    the fold must not depend on the order of rows. Groups are folded in bounded pieces and
    the pieces merged in two more levels, each of bounded width for groups up to
    ``piece_rows ** 3`` rows.
    """
    pieces = group_rows(df, keys, value, piece_rows)
    folded = pieces.select(*keys, "piece", F.aggregate("items", start, step).alias("result"))
    for width in (piece_rows, None):
        upper = F.floor(F.col("piece") / width) if width else F.lit(0)
        folded = (
            folded.withColumn("piece", upper.cast("long"))
            .groupBy(*keys, "piece")
            .agg(F.collect_list("result").alias("results"))
            .select(*keys, "piece", F.reduce("results", start, merge).alias("result"))
        )
    return folded.drop("piece")


def concat_lists(df: DataFrame, keys: list[str], lists: str, piece_rows: int = 10_000) -> DataFrame:
    """Concatenate the list values of each group, in pieces as :func:`group_rows` gives them.

    A group whose lists are all empty or missing is one empty piece.
    """
    items = df.select(*keys, F.explode(lists).alias("item"))
    pieces = group_rows(items, keys, F.col("item"), piece_rows)
    longest = df.groupBy(*keys).agg(F.coalesce(F.max(F.when(F.col(lists).isNotNull(), F.size(lists))), F.lit(0)).alias("longest"))
    kinds = {f.name: f.dataType for f in pieces.schema.fields}
    empty = longest.filter(F.col("longest") == 0).select(
        *keys, F.lit(0).cast(kinds["piece"]).alias("piece"), F.lit(1).cast(kinds["pieces"]).alias("pieces"), F.array().cast(kinds["items"]).alias("items")
    )
    return pieces.unionByName(empty)


def roll_up_counters(word_counts: DataFrame, document_counts: DataFrame) -> DataFrame:
    """Counters at four levels as typed rows ``(label, word, level, n)``.

    ``label_word`` and ``label_words`` come from the ``(label, word, n)`` table, ``label`` and
    ``all`` from the ``(label, n)`` table of documents. Both inputs are already grouped, so the
    expansion that a roll-up makes touches distinct keys rather than tokens.
    """
    level = F.when(F.grouping("word") == 0, "label_word").otherwise("label_words")
    by_word = (
        word_counts.groupingSets([["label", "word"], ["label"]], "label", "word")
        .agg(level.alias("level"), F.sum("n").alias("n"))
        .select("label", "word", "level", "n")
    )
    level = F.when(F.grouping("label") == 0, "label").otherwise("all")
    by_label = (
        document_counts.rollup("label")
        .agg(level.alias("level"), F.sum("n").alias("n"))
        .select("label", F.lit(None).cast("string").alias("word"), "level", "n")
    )
    return by_word.unionByName(by_label)
