"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusml.storage import discard, materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every linked node; ``links`` has two id columns ``a`` and ``b``.

    Each round joins every node's neighbours to the smallest of them, first to larger neighbours, then
    to smaller ones, until nothing changes: a few rounds for the shallow trees that link
    searches give. A round is two joins on node ids with sums combined before each shuffle, and
    is stored in the shared folder. Links of a node to itself are ignored.
    """
    larger, smaller = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = materialize(links.filter("a != b").select(larger, smaller).distinct(), "links")
    mark = _mark(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        wide = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # A node keeps its own link to the smallest neighbour as well.
        wide = wide.unionByName(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()
        roots = wide.groupBy("a").agg(F.min("b").alias("m"))
        narrow = wide.join(roots, "a")
        narrow = narrow.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(narrow.select("a", F.col("m").alias("b")))
        following = materialize(narrow.filter("a != b").distinct(), "links")
        now = _mark(following)
        discard(edges)
        edges = following
        if now == mark:
            break
        mark = now
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).collect()[0]
    return row["n"], row["h"]
