"""Mini-batches for the iterative jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.operators.ranking import shuffled_rank


def assign(df: DataFrame, idx: str, batch_size: int, seed: int = 0, epoch: int = 0, shuffle: bool = True) -> DataFrame:
    """Add ``rank``, the place of a row in the epoch, and ``batch``; the last batch may be short.

    With ``shuffle`` the order is a permutation drawn from seed and epoch, else the order of
    ``idx``, which must then be contiguous from 0.
    """
    if shuffle:
        df = shuffled_rank(df, idx, seed, epoch)
    else:
        df = df.withColumn("rank", F.col(idx).cast("long"))
    return df.withColumn("batch", F.floor(F.col("rank") / batch_size).cast("int"))
