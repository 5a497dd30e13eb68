"""Written tables that end with the call that made them."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from scanlake.session import shared_folder


class Tables:
    """Intermediate tables of one call, in a folder of its own below the shared one.

    Used as a context: leaving it, also by an error, removes every table but those
    written by ``result``. Two calls at once never share a folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.number = 0

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *error) -> None:
        self._remove(self.folder)

    def written(self, rows: DataFrame, name: str) -> DataFrame:
        """Rows as a table, read back: cheap to read again and safe from lost executors."""
        self.number += 1
        return self._write(rows, f"{self.folder}/{self.number}-{name}")

    def result(self, rows: DataFrame) -> DataFrame:
        """Rows as a table that outlives the call: what a lazy result reads."""
        return self._write(rows, f"{self.folder}-result")

    def remove(self, *tables: DataFrame) -> None:
        """Remove tables that no later step reads, before the call ends, and let go of finished shuffles.

        Spark keeps the shuffle files of a finished step until the driver's heap is collected.
        """
        for table in tables:
            for file in table.inputFiles()[:1]:
                self._remove(file.rsplit("/", 1)[0])
        gc.collect()
        self.spark._jvm.System.gc()

    def _write(self, rows: DataFrame, path: str) -> DataFrame:
        rows.write.parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def _remove(self, path: str) -> None:
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
