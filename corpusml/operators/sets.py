"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def union_distinct(*views: DataFrame) -> DataFrame:
    """Set union: duplicates are removed, also those inside one view."""
    return reduce(DataFrame.unionByName, views).distinct()


def difference(left: DataFrame, *others: DataFrame) -> DataFrame:
    """Distinct rows of the first view that are in none of the others."""
    return reduce(DataFrame.subtract, others, left)
