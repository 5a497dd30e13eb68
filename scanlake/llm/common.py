"""Shared pieces: shipping the package to Python workers, written tables, ids of rows."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

from scanlake.session import configure, shared_folder

#: White space that parts words: space and 0x09 to 0x0D.
WORD = r"[^\x20\x09-\x0D]+"

_shipped: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """Session settings of the package, and its modules on every Python worker.

    The package travels as a file of the Spark job, so workers import it by name and
    what a module caches (a vocabulary, a trained model) lives as long as the worker.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        data = io.BytesIO()
        with zipfile.ZipFile(data, "w") as archive:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, os.path.dirname(package)))
        place = os.path.join(tempfile.mkdtemp(prefix="scanlake-"), "scanlake_package.zip")
        with open(place, "wb") as file:
            file.write(data.getvalue())
        context.addPyFile(place)
        _shipped.add(context.applicationId)
    # A worker holds a batch of texts, their ids and their bytes at once: rows are long.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return configure(spark)


def written(rows: DataFrame, name: str) -> DataFrame:
    """Rows as a table in the shared folder, read back.

    The name gets a part of its own, so calls never overwrite each other. Reading is
    cheap and survives lost executors, which recomputing a plan many times would not be.
    """
    path = f"{shared_folder(rows.sparkSession)}/{name}-{uuid.uuid4().hex}"
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def free_name(taken: list[str], name: str) -> str:
    """A column name that no input column has, whatever the case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
