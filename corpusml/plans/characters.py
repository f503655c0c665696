"""Character-level examples from labelled entity names.

Entities are ``(idx long, entity string, labels array<string>)``, one view each for training,
validation and test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusml.functions.text import characters
from corpusml.operators.ranking import sorted_rank
from corpusml.operators.sets import difference, union_distinct
from corpusml.storage import materialize

# Unicode has 0x110000 code points, so a table of characters has a fixed bound.
MAX_CHARACTERS = 0x110000


def character_set(entities: DataFrame) -> DataFrame:
    return entities.select(F.explode(characters("entity")).alias("char")).distinct()


def vocabulary(*views: DataFrame) -> DataFrame:
    """``(char, char_id)`` over all views: the space is 0, the others follow in sorted order."""
    space = views[0].sparkSession.range(1).select(F.lit(" ").alias("char"))
    chars = union_distinct(*[character_set(v) for v in views], space)
    ranked = sorted_rank(chars.withColumn("_key", F.struct((F.col("char") != " ").alias("other"), "char")), "_key", "char_id")
    return ranked.select("char", F.col("char_id").cast("int").alias("char_id"))


def unseen_characters(test: DataFrame, train: DataFrame, valid: DataFrame) -> DataFrame:
    """Characters of the test view that occur in neither other view."""
    return difference(character_set(test), character_set(train), character_set(valid))


def label_dictionary(*views: DataFrame) -> DataFrame:
    """``(label, label_id)`` over the given views, numbered from 0 in sorted order."""
    labels = union_distinct(*[v.select(F.explode("labels").alias("label")) for v in views])
    return sorted_rank(labels, "label", "label_id").select("label", F.col("label_id").cast("int").alias("label_id"))


def dictionaries(*views: DataFrame, labelled: list[DataFrame]) -> tuple[DataFrame, DataFrame]:
    """The character and the label dictionary, written out: every later step reads them again,
    and none should go through the names once more for it."""
    chars = materialize(vocabulary(*views), "dictionary-characters")
    return chars, materialize(label_dictionary(*labelled), "dictionary-labels")


def code_points(chars: DataFrame) -> DataFrame:
    """One row and column: the ids of all characters up to the largest, each at the place of its code point."""
    at = F.ascii("char").cast("long").alias("at")  # the code point, also beyond the basic plane
    top = chars.agg(F.max(at)).first()[0] or 0
    if top >= MAX_CHARACTERS:
        raise ValueError("not a character")
    every = chars.sparkSession.range(top + 1).select(F.col("id").alias("at")).join(chars.select(at, "char_id"), "at", "left")
    listed = F.sort_array(F.collect_list(F.struct("at", "char_id")))
    return every.agg(F.transform(listed, lambda x: x["char_id"]).alias("ids"))


def encode(entities: DataFrame, chars: DataFrame, labels: DataFrame) -> DataFrame:
    """``(idx, chars array<int>, labels array<int>)``; a label not in the dictionary becomes 0.

    A character is looked up at its place in a table of code points, whose size has a fixed bound. Labels meet their
    numbers in a join and return to their row in their order.
    """
    table = code_points(chars)
    found = entities.select("idx", F.posexplode("labels").alias("at", "label")).join(labels, "label", "left")
    listed = F.array_sort(F.collect_list(F.struct("at", F.coalesce("label_id", F.lit(0)).alias("label_id"))))
    of_row = found.groupBy("idx").agg(F.transform(listed, lambda x: x["label_id"]).alias("ids"))
    rows = entities.select("idx", characters("entity").alias("c")).withColumn("table", table.scalar())
    coded = rows.select("idx", F.transform("c", lambda x: F.get("table", F.ascii(x))).alias("chars"))
    return coded.join(of_row, "idx", "left").select("idx", "chars", F.coalesce("ids", F.array().cast("array<int>")).alias("labels"))


def window_of(chars: Column | str, max_len: int) -> Column:
    """The first ``max_len`` ids; a shorter name has no entry, hence a zero row, at the end."""
    return F.slice(chars, 1, max_len)


def steps(chars: Column | str, max_len: int) -> Column:
    """The ids in the order a recurrent model reads them: padded with NULL, then reversed."""
    cut = window_of(chars, max_len)
    missing = F.array_repeat(F.lit(None).cast("int"), F.lit(max_len) - F.size(cut))
    return F.reverse(F.concat(cut, missing))


def one_hot_positions(chars: Column | str, max_len: int, num_chars: int) -> Column:
    """Places of the ones in the flattened ``max_len x num_chars`` one-hot input row."""
    return F.transform(window_of(chars, max_len), lambda c, i: i * num_chars + c)


def multi_hot(labels: Column | str, num_labels: int) -> Column:
    """Dense 0/1 vector of the labels."""
    return F.transform(F.sequence(F.lit(0), F.lit(num_labels - 1)), lambda k: F.array_contains(labels, k).cast("double"))


def target(labels: Column | str, num_labels: int) -> Column:
    """:func:`multi_hot` scaled to sum 1, as cross entropy against a softmax assumes."""
    hot = multi_hot(labels, num_labels)
    return F.transform(hot, lambda y: y / F.size(F.array_distinct(labels)))
