"""A load becomes visible in its table and its export at once, whatever fails in between.

Next to a table lies its log, with a folder for each load:

* ``rows``: the built rows, written before anything is published;
* ``ready``: a small file, created when the rows are complete. From then on the load is
  decided, and a rerun finishes it without reading a raw line again;
* ``published``: a small file, created when table and export both have the load. Creating
  it is the one step that makes the load visible.

Each step of a decided load may be repeated: it replaces the table folder of the load
(``load=<id>``) and the export folders of its sources, which nothing else writes. A load
that was never ready is not used by anyone, and its sources count as not loaded.
"""

from __future__ import annotations

import json
import uuid
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.sources.sinks import EmptyResult, write_base_table, write_json_export

READY, PUBLISHED = "ready", "published"
#: Bytes of a clustered file before compression by columns, roughly.
CLUSTER_BYTES = 256 << 20


class Load(NamedTuple):
    """A decided load: its folder in the log, sources, number of rows and where it is exported."""

    number: str
    sources: list[str]
    rows: int
    export: str | None


class Log:
    """The loads of a table."""

    def __init__(self, spark: SparkSession, table: str):
        self.spark, self.table = spark, table.rstrip("/")
        self.folder = f"{self.table}_log"
        hadoop = spark._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path
        self._files = hadoop.Path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _exists(self, *parts: str) -> bool:
        return self._files.exists(self._path("/".join((self.folder, *parts))))

    def _create(self, text: str, *parts: str) -> bool:
        """Create a small file; False if it is there already."""
        place = self._path("/".join((self.folder, *parts)))
        try:
            out = self._files.create(place, False)
        except Py4JJavaError:
            if self._files.exists(place):
                return False
            raise
        out.write(bytearray(text.encode()))
        out.close()
        return True

    def remove(self, *parts: str) -> None:
        self._files.delete(self._path("/".join((self.folder, *parts))), True)

    def loads(self, published: bool) -> list[Load]:
        """Decided loads, a row of a listing each, that are published or not yet."""
        if not self._exists():
            return []
        found = []
        for entry in self._files.listStatus(self._path(self.folder)):
            number = entry.getPath().getName()
            if self._exists(number, READY) and self._exists(number, PUBLISHED) == published:
                about = self.spark.read.text(f"{self.folder}/{number}/{READY}", wholetext=True).first()
                found.append(Load(number, **json.loads(about["value"])))
        return found

    def table_folders(self) -> list[str]:
        """Folders of the published loads."""
        return [f"{self.table}/load={load.number}" for load in self.loads(True)]

    def stage(self, rows: DataFrame, sources: list[str], export: str | None = None) -> Load:
        """Write the rows of a load and decide it. Rows that are none are an error, and nothing stays of them."""
        number = uuid.uuid4().hex
        try:
            rows.write.parquet(f"{self.folder}/{number}/rows")
            count = self.spark.read.parquet(f"{self.folder}/{number}/rows").count()  # of file footers
            if count == 0:
                raise EmptyResult("zero rows were created although there were new files")
        except BaseException:
            self.remove(number)
            raise
        load = Load(number, sources, count, export)
        self._create(json.dumps({"sources": sources, "rows": count, "export": export}), number, READY)
        return load

    def publish(self, load: Load) -> None:
        """Bring a decided load into table and export, then make it visible."""
        path = f"{self.folder}/{load.number}/rows"
        rows = self.spark.read.parquet(path)
        size = self._files.getContentSummary(self._path(path)).getLength()
        files = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-size // CLUSTER_BYTES))
        write_base_table(rows, f"{self.table}/load={load.number}", partitions=files)
        if load.export is not None:
            write_json_export(rows, load.export)
        self._create("", load.number, PUBLISHED)
        self.remove(load.number, "rows")

    def finish(self) -> list[Load]:
        """Publish what an earlier run has decided and not published."""
        pending = self.loads(False)
        for load in pending:
            self.publish(load)
        return pending


def read_published(spark: SparkSession, table: str) -> DataFrame | None:
    """The published rows of a table; None if there are none."""
    folders = Log(spark, table).table_folders()
    if not folders:
        return None
    return spark.read.option("basePath", table).parquet(*folders).drop("load")


def published_sources(spark: SparkSession, table: str) -> DataFrame:
    """``source`` of all published loads, from the log alone."""
    names = [(s,) for load in Log(spark, table).loads(True) for s in load.sources]
    return spark.createDataFrame(names, "source STRING").select(F.col("source"))
