"""Top-k per group and exact row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusml.functions.text import digest_bits
from corpusml.storage import materialize


def top_k(df: DataFrame, group: str, order: list[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each group and their rank.

    The filter on ``row_number`` lets Spark keep only ``k`` rows per group and task before
    the shuffle, so a hot group sends ``k`` rows per task and no more.
    """
    window = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)


def hashed_rank(df: DataFrame, digest: Column, tie: Column, name: str = "rank", bits: int = 16) -> DataFrame:
    """0-based position of every row when sorted by ``(digest, tie)``.

    ``digest`` is a 32-bit hash (see :func:`corpusml.functions.text.digest_bits`) of something
    distinct, so its leading bits cut the rows into even ranges. Each range is numbered on its
    own and shifted by the size of the ranges before it: no task sorts the whole table. Give
    ``bits`` so that ``2 ** bits`` ranges keep one range within a task; the range table has
    at most that many rows.
    """
    rows = df.withColumn("_digest", digest).withColumn("_tie", tie)
    rows = rows.withColumn("_range", F.shiftright("_digest", 32 - bits))
    return _numbered(rows, ["_range"], ["_digest", "_tie"], name).drop("_digest", "_tie", "_range")


def sorted_rank(df: DataFrame, key: str, name: str = "rank") -> DataFrame:
    """0-based position of every row when sorted by ``key``, a column of distinct values.

    Rows are cut into ranges at sampled split points and stored with their range, so that all later
    steps see the same ranges. Each range is numbered on its own and shifted by the sizes of the ranges before it.
    """
    ranged = df.repartitionByRange(F.col(key)).withColumn("_range", F.spark_partition_id())
    return _numbered(materialize(ranged, "ranges"), ["_range"], [key], name).drop("_range")


def file_rank(lines: DataFrame, name: str = "idx") -> DataFrame:
    """0-based line number over the files of a text source, in path order.

    Takes the ``path``, ``block`` and ``position`` columns of
    :func:`corpusml.sources.text.numbered_lines`; a block is one file split.
    """
    return _numbered(lines, ["path", "block"], ["position"], name).drop("path", "block", "position")


def shuffled_rank(df: DataFrame, idx: str, seed: int, epoch: int, name: str = "rank", bits: int = 16) -> DataFrame:
    """Position of every row in a permutation that depends only on seed, epoch and row id."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(str(epoch)), F.col(idx).cast("string"))
    return hashed_rank(df, digest_bits(text), F.col(idx), name, bits)


def _numbered(rows: DataFrame, ranges: list[str], order: list[str], name: str) -> DataFrame:
    sizes = rows.groupBy(*ranges).agg(F.count(F.lit(1)).alias("_size"))
    # One row per range: a window over them is small whatever the table holds.
    before = Window.orderBy(*ranges).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*ranges, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*ranges).orderBy(*order)
    numbered = rows.withColumn("_inside", F.row_number().over(inside)).join(starts, ranges)
    return numbered.withColumn(name, F.col("_start") + F.col("_inside") - 1).drop("_start", "_inside")
