"""Matrix products.

A matrix is either long, ``(i, j, v)`` rows, or one array per row. The long form has no size
limit on either side. When the right matrix is small, :func:`times_small` keeps it next to the
rows instead and needs no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusml.functions.vectors import row_times_matrix
from corpusml.operators.rows import augment


def to_long(df: DataFrame, idx: str, vector: str) -> DataFrame:
    """``(i, j, v)`` entries of a matrix stored one row per record."""
    return df.select(F.col(idx).alias("i"), F.posexplode(vector).alias("j", "v"))


def product(a: DataFrame, b: DataFrame) -> DataFrame:
    """Product of two long matrices: join on the inner index, sum per cell.

    The inner index has few values when ``a`` is tall; adaptive execution then splits the
    partitions of ``a`` in the join. Products are added up before the shuffle to their cell.
    """
    left = a.select("i", F.col("j").alias("inner"), F.col("v").alias("x"))
    right = b.select(F.col("i").alias("inner"), "j", F.col("v").alias("y"))
    return left.join(right, "inner").groupBy("i", "j").agg(F.sum(F.col("x") * F.col("y")).alias("v"))


def transpose(a: DataFrame) -> DataFrame:
    return a.select(F.col("j").alias("i"), F.col("i").alias("j"), "v")


def product_grad_left(delta: DataFrame, b: DataFrame) -> DataFrame:
    """Error of the left factor of ``a b``: the incoming error times ``b`` transposed."""
    return product(delta, transpose(b))


def product_grad_right(a: DataFrame, delta: DataFrame) -> DataFrame:
    """Error of the right factor of ``a b``: ``a`` transposed times the incoming error."""
    return product(transpose(a), delta)


def bias_grad(delta: DataFrame) -> DataFrame:
    """``(j, v)``: error of a vector that was added to every row, the sum over the rows."""
    return delta.groupBy("j").agg(F.sum("v").alias("v"))


def mean_grad(delta: Column, count: Column) -> Column:
    """Error of each of ``count`` values whose mean has the error ``delta``."""
    return delta / count


def times_small(df: DataFrame, vector: str, columns: DataFrame, name: str, max_rows: int = 10_000) -> DataFrame:
    """Multiply every row vector with a small matrix given as ``(j, column array<double>)`` rows.

    The matrix must pass a size check; larger ones go through :func:`product`.
    """
    def packed(view: DataFrame) -> DataFrame:
        return view.agg(F.sort_array(F.collect_list(F.struct("j", "column")))["column"].alias("columns"))

    paired = augment(df, columns, packed, "_columns", max_rows)
    return paired.withColumn(name, row_times_matrix(vector, "_columns")).drop("_columns")
