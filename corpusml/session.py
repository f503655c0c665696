"""Session construction."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "corpusml",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Return a session with the settings the jobs in this package expect.

    Nothing here is needed for right results. Adaptive execution is what picks
    broadcast joins from measured sizes, splits skewed join partitions and merges
    small shuffle partitions, so it is switched on even if the cluster default is off.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Rows can be long texts; keep an Arrow batch to a size a Python worker can hold.
        "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of every executor, once per context."""
    context = spark.sparkContext
    if getattr(context, "_corpusml_shipped", False):
        return
    package = Path(__file__).parent
    target = Path(tempfile.mkdtemp(prefix="corpusml-package-")) / package.name
    context.addPyFile(shutil.make_archive(str(target), "zip", package.parent, package.name))
    context._corpusml_shipped = True
