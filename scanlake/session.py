"""Session settings the plans in this package are designed for."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Joins here rely on run-time size checks (auto broadcast) and on AQE splitting
# hot shuffle partitions, so both stay on; timestamps are handled in UTC. Wide rows give
# generated methods of over 8000 bytes, which the JVM interprets instead of compiling: above
# that size Spark splits the projections of a stage into methods that are compiled.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give this package to every Python worker, once per application, for functions that run there."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    place = os.path.join(tempfile.mkdtemp(prefix="scanlake-"), "scanlake_core.zip")  # on the driver, which serves it
    with open(place, "wb") as file:
        file.write(data.getvalue())
    context.addPyFile(place)
    _shipped.add(context.applicationId)


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for staged tables.

    A cluster names it in ``spark.checkpoint.dir``. A local session without the
    setting gets a fresh temporary folder; a cluster without it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="scanlake-")
    return _local_folders[context.applicationId]
