"""Row operators: map, flat map, filter, partition map, side tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


# Rows of a side view that every task may hold.
MAX_SIDE_ROWS = 100_000


def map_rows(df: DataFrame, *keep: Column | str, **computed: Column) -> DataFrame:
    """One output row per input row: the kept columns and the computed ones."""
    return df.select(*keep, *[expr.alias(name) for name, expr in computed.items()])


def map_partitions(
    df: DataFrame, by: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]], schema: str
) -> DataFrame:
    """Apply a function from row batches to row batches to every partition (Arrow transfer)."""
    return df.mapInPandas(by, schema)


def flat_map(df: DataFrame, items: Column, name: str, *keep: Column | str) -> DataFrame:
    """Zero or more output rows per input row: one per element of an array expression."""
    return df.select(*keep, F.explode(items).alias(name))


def flat_map_function(df: DataFrame, by: Callable[[object], list], item: str, name: str, kind: str, *keep: str) -> DataFrame:
    """Flat map by a Python function that no array expression covers.

    ``by`` turns the value of column ``item`` into a list; each element becomes a row with the kept
    columns. Rows travel in Arrow batches.
    """
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = frame[list(keep)].assign(**{name: [by(value) for value in frame[item]]}).explode(name)
            # A row without elements gives none.
            yield out[out[name].notna()]

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for k in keep for f in [df.schema[k]]]
    return df.select(*dict.fromkeys([*keep, item])).mapInPandas(run, ", ".join([*fields, f"`{name}` {kind}"]))


def filter_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Keep the rows where the condition is true; NULL drops the row."""
    return df.filter(condition)


def label_words(docs: DataFrame, words: Column, *keep: str, labels: str = "labels") -> DataFrame:
    """One row per (label, word occurrence) of a labelled document.

    Words are exploded before labels so that each text is tokenized once, however many
    labels it has.
    """
    one_word = docs.select(*keep, labels, F.explode(words).alias("word"))
    return one_word.select(*keep, F.explode(labels).alias("label"), "word")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Use all cores on an input that is stored in too few splits.

    For tables as read from files: a table in at least as many splits as there are cores, as
    any large one is, passes through untouched. Smaller ones are hashed on the given keys.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores, *keys)


def only_row(view: DataFrame):
    """The one row of a view; an error if it has none or several."""
    rows = view.limit(2).collect()
    if len(rows) != 1:
        raise ValueError("expected exactly one row, found " + ("none" if not rows else "several"))
    return rows[0]


def fits(side: DataFrame, max_rows: int) -> bool:
    """Whether a side table has at most ``max_rows`` rows; reads no more than it must."""
    return side.limit(max_rows + 1).count() <= max_rows


def augment(
    df: DataFrame,
    sides: DataFrame | list[DataFrame],
    loaded_by: Callable[..., DataFrame],
    name: str = "side",
    max_rows: int = MAX_SIDE_ROWS,
) -> DataFrame:
    """Pair every row with a value loaded from whole side views.

    ``loaded_by`` turns the side views into a view of one row and one column. That value
    reaches the rows as an uncorrelated scalar subquery: it is computed once, and a loader
    that returns more than one row fails. The sides must pass a size check, since every task
    holds the value; for a larger side use :func:`corpusml.operators.joins.lookup`, which
    fetches only the entry each row needs, through a join of any size.
    """
    sides = [sides] if isinstance(sides, DataFrame) else list(sides)
    for side in sides:
        if not fits(side, max_rows):
            raise ValueError(f"side view has more than {max_rows} rows; use joins.lookup")
    return df.withColumn(name, loaded_by(*sides).scalar())


def as_map(side: DataFrame, key: str, value: str, max_rows: int = MAX_SIDE_ROWS) -> DataFrame:
    """One row holding a two-column view as a map; a loader for :func:`augment`.

    A larger view is an error. The limit is one above the bound, so that no task gathers more
    than that before the excess is noticed.
    """
    gathered = side.limit(max_rows + 1).agg(F.collect_list(F.struct(key, value)).alias("pairs"))
    too_many = F.raise_error(F.lit(f"side view has more than {max_rows} rows; use joins.lookup"))
    return gathered.select(
        F.when(F.size("pairs") <= max_rows, F.map_from_entries("pairs")).otherwise(too_many).alias("entries")
    )
