"""Shared-folder tables: stored views, and lineage cuts for iterative jobs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local-mode session that names no folder gets a fresh temporary one; on a
    cluster a missing setting is an error, because a machine-local folder would be lost
    with its executor.
    """
    folder = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="corpusml-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str, partition_by: list[str] | None = None, rebalance: bool = True) -> DataFrame:
    """Write a view as parquet and return the stored copy; ``rebalance=False`` if rows of a directory are together already."""
    if partition_by and rebalance:
        # Rows of one directory come together in few files; a large directory is still split.
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def reuse(spark: SparkSession, path: str) -> DataFrame:
    """Read back a stored view instead of computing it again."""
    return spark.read.parquet(path)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, rebalance: bool = True) -> DataFrame:
    """Cut lineage: write to the shared folder and continue from the written table.

    Parquet rather than ``checkpoint()`` keeps column pruning, partition pruning and size
    statistics for the readers, and the files outlive any executor.
    """
    path = scratch_path(df.sparkSession, name)
    table = store(df, path, partition_by, rebalance)
    table.scratch_path = path
    return table


def discard(table: DataFrame) -> None:
    """Remove the files of a frame that :func:`materialize` returned, once a newer round exists.

    Any other frame is left alone, also one derived from it.
    """
    path = getattr(table, "scratch_path", None)
    if path is not None:
        _remove(table.sparkSession, path)


class Pieces:
    """A table in numbered pieces, of which single ones can be replaced; the others stay untouched.

    Each piece is a folder below the shared folder. A replacement writes new folders and removes the old ones only once
    all of them are complete, so a failed attempt leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, name: str, schema: str) -> None:
        self.spark, self.name, self.schema = spark, name, schema
        self.paths: dict[int, str] = {}

    def read(self, numbers: list[int] | None = None) -> DataFrame | None:
        """Rows of the given pieces, or of all; None if there are none."""
        paths = [p for n, p in sorted(self.paths.items()) if numbers is None or n in set(numbers)]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else None

    def replace(self, rows: DataFrame, numbers: list[int]) -> None:
        """Write ``rows``, which have a column ``part`` and fill every piece of ``numbers``, in place of those pieces."""
        path = scratch_path(self.spark, self.name)
        rows.hint("rebalance", "part").write.partitionBy("part").parquet(path)
        old = [self.paths[n] for n in numbers if n in self.paths]
        self.paths.update({n: f"{path}/part={n}" for n in numbers})
        for folder in old:
            _remove(self.spark, folder)


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
