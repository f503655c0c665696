"""Documents in blocks that fetch what a model knows of their terms, each term once a block.

A join of (document, term) rows with a model moves the entry of a term once for every document that has it, and every
document is put together again afterwards. Here documents are dealt into blocks of bounded size by a hash of their id;
a block names its distinct terms, these meet the model in a join, and the found rows return to the block.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sum of the sizes of the documents of a block, about; a single larger document is a block of its own.
BLOCK_SIZE = 16 << 20


def in_blocks(docs: DataFrame, idx: str, size: Column, block_size: int = BLOCK_SIZE) -> DataFrame:
    """Add ``_block`` and bring the documents of a block together; rows that share an id share a block."""
    total = docs.agg(F.sum(size.cast("double"))).first()[0] or 0.0
    number = max(int(total // block_size) + 1, docs.sparkSession.sparkContext.defaultParallelism)
    return docs.withColumn("_block", F.pmod(F.xxhash64(idx), F.lit(number)).cast("int")).repartition(number, "_block")


def meet(
    blocked: DataFrame,
    terms: Callable[[pa.RecordBatch], Iterator],
    term: str,
    kind: str,
    model: DataFrame,
    run: Callable[[pa.Table, pa.Table], pa.Table],
    schema: str,
) -> DataFrame:
    """``run(documents, found)`` of every block, ``found`` being the rows of ``model`` that have a term of the block.

    ``blocked`` comes from :func:`in_blocks`. ``terms`` gives the terms of each row of a batch, ``term`` is the column of
    the model that holds them. Documents are shuffled once, for both uses.
    """

    def distinct(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A partition holds whole blocks, so this is all of their terms, each once.
        known: dict[int, set] = {}
        for part in parts:
            for block, own in zip(part.column("_block").to_pylist(), terms(part)):
                known.setdefault(block, set()).update(own)
        for block, own in known.items():
            listed = list(own)
            for at in range(0, len(listed), 100_000):
                some = listed[at : at + 100_000]
                columns = [pa.array([block] * len(some), pa.int32()), pa.array(some, pa.binary() if kind == "string" else pa.int64())]
                if kind == "string":
                    columns[1] = columns[1].cast(pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=["_block", term])

    wanted = blocked.mapInArrow(distinct, f"_block int, {term} {kind}")
    found = wanted.join(model, term)
    return blocked.groupBy("_block").cogroup(found.groupBy("_block")).applyInArrow(run, schema)
