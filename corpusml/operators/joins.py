"""Equi-joins.

No side is broadcast by hint. Spark compares the measured size of a side with
``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles both, and adaptive execution
splits a partition that a hot key has made too large.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Keys = list[tuple[Column, Column]]


def _condition(keys: Keys, null_safe: bool) -> Column:
    pairs = [(a.eqNullSafe(b) if null_safe else a == b) for a, b in keys]
    return reduce(lambda x, y: x & y, pairs)


def join(
    left: DataFrame,
    right: DataFrame,
    keys: Keys,
    left_outer: bool = False,
    right_outer: bool = False,
    null_safe: bool = False,
) -> DataFrame:
    """Join on computed keys, keeping the columns of both sides.

    ``left_outer`` keeps unmatched left rows, ``right_outer`` unmatched right rows.
    ``null_safe`` lets missing keys match each other, as equal values do.
    """
    if left_outer and right_outer:
        return _full_join(left, right, keys, null_safe)
    how = "left" if left_outer else "right" if right_outer else "inner"
    return left.join(right, _condition(keys, null_safe), how)


def _full_join(left: DataFrame, right: DataFrame, keys: Keys, null_safe: bool) -> DataFrame:
    # A full outer join cannot be split at a hot key and a left outer one on its left side only. An inner
    # join can be split on either side; the anti joins see each key of the other side once.
    matched = left.join(right, _condition(keys, null_safe), "inner")
    names = [f"_key{i}" for i in range(len(keys))]
    left_keys = left.select(*[a.alias(n) for n, (a, _) in zip(names, keys)]).distinct()
    right_keys = right.select(*[b.alias(n) for n, (_, b) in zip(names, keys)]).distinct()
    left_only = left.join(right_keys, _condition([(a, right_keys[n]) for n, (a, _) in zip(names, keys)], null_safe), "left_anti")
    right_only = right.join(left_keys, _condition([(left_keys[n], b) for n, (_, b) in zip(names, keys)], null_safe), "left_anti")

    def nothing(of: DataFrame) -> list[Column]:
        return [F.lit(None).cast(f.dataType).alias(f.name) for f in of.schema.fields]

    matched = matched.union(left_only.select(*[left[c] for c in left.columns], *nothing(right)))
    return matched.union(right_only.select(*nothing(left), *[right[c] for c in right.columns]))


def join_all(views: list[DataFrame], on: list[str]) -> DataFrame:
    """Inner join of any number of views that share the key columns."""
    return reduce(lambda a, b: a.join(b, on), views)


def lookup(df: DataFrame, side: DataFrame, key: str, value: str, default: Column | None = None) -> DataFrame:
    """Add ``value`` from a keyed side table, or the default where the key is missing.

    A missing value that the side table has for a key stays missing. The side table must have each
    key once, or rows are multiplied.
    """
    if default is None:
        return df.join(side.select(key, value), key, "left")
    found = df.join(side.select(key, value, F.lit(True).alias("_found")), key, "left")
    return found.withColumn(value, F.when(F.col("_found"), F.col(value)).otherwise(default)).drop("_found")
