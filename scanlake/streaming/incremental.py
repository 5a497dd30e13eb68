"""Incremental load as a file stream: the stream tells which sources have new files."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from scanlake.functions.paths import filename_matches, source_of
from scanlake.session import ship_package
from scanlake.sources.files import list_files, read_lines
from scanlake.sources.sinks import write_base_table

#: Columns of a file as the binary source has them; only the path is used.
FILE = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def stream_files(spark: SparkSession, folder: str, names: Sequence[str]) -> DataFrame:
    """``path`` and ``source`` of new files with one of the given names; contents are not read."""
    files = spark.readStream.format("binaryFile").schema(FILE).option("recursiveFileLookup", "true").load(folder).select("path")
    return files.filter(filename_matches(F.col("path"), list(names))).withColumn("source", source_of(F.col("path")))


CLOSED = "source STRING, complete BOOLEAN"
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Completion(StatefulProcessor):
    """Of each source, the kinds of file that have come. It is told of once all are there.

    A source that waits is told of as incomplete when its timer ends, ``wait_ms`` after its
    first file. A file that comes to a source that was told of already tells of it again.
    """

    def __init__(self, kinds: Sequence[str], wait_ms: int | None):
        self.all_kinds, self.wait_ms = set(kinds), wait_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.kinds = handle.getMapState("kinds", "kind STRING", "seen BOOLEAN")
        self.told = handle.getValueState("told", "told BOOLEAN")

    def _tell(self, source: str, complete: bool) -> pd.DataFrame:
        self.told.update((True,))
        return pd.DataFrame({"source": [source], "complete": [complete]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = not self.kinds.exists()
        for frame in rows:
            for kind in frame["kind"].unique():
                self.kinds.updateValue((kind,), (True,))
        complete = self.all_kinds <= {k[0] for k in self.kinds.keys()}
        if complete or self.told.exists():
            for timer in list(self.handle.listTimers()) if self.wait_ms is not None else []:
                self.handle.deleteTimer(timer)
            yield self._tell(key[0], complete)
        elif first and self.wait_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.wait_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.told.exists():
            yield self._tell(key[0], False)

    def close(self) -> None:
        pass


def closed_sources(files: DataFrame, kinds: Mapping[str, Sequence[str]], wait_ms: int | None = None) -> DataFrame:
    """``source`` and ``complete`` of the stream of files, once all kinds of file of a source are there.

    ``kinds``: file names by kind; other files are not waited for.
    """
    spark = files.sparkSession
    ship_package(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    kind = F.coalesce(*[F.when(filename_matches(F.col("path"), list(names)), kind) for kind, names in kinds.items()])
    known = files.select("source", kind.alias("kind")).where(F.col("kind").isNotNull())
    return known.groupBy("source").transformWithStateInPandas(Completion(list(kinds), wait_ms), CLOSED, "Append", "None" if wait_ms is None else "ProcessingTime")


def load_new_files(
    spark: SparkSession,
    folder: str,
    names: Sequence[str],
    build: Callable[[DataFrame], DataFrame],
    path: str,
    checkpoint: str,
    kinds: Mapping[str, Sequence[str]] | None = None,
    wait_ms: int | None = None,
) -> StreamingQuery:
    """Bring the table up to date with all files that arrived since the last run, then stop.

    With ``kinds`` (file names by kind) a source waits, over runs, until it has files of all
    kinds, and is built once then; without, it is built in every run that brings a file of
    it. With ``wait_ms``, after which a source is built as it is, the stream runs on until it
    is stopped: a timer needs batches to end in.

    The files of a source belong together (measurements, tags, page fetches), so a source
    with a new file is built anew from all its files. It owns the folder of its name, which
    that replaces: arriving in parts gives the same table as arriving at once, and a batch
    that is repeated after a failure loads nothing twice.
    """

    def renew(batch: DataFrame, number: int) -> None:
        # One name per scan folder with new files.
        sources = [row["source"] for row in batch.select("source").distinct().toLocalIterator()]
        listed = list_files(spark, folder).filter(filename_matches(F.col("path"), list(names)))
        listed = listed.withColumn("source", source_of(F.col("path")))
        for source in sources:
            paths = [row["path"] for row in listed.filter(F.col("source") == source).select("path").toLocalIterator()]
            write_base_table(build(read_lines(spark, paths)), f"{path}/load={source}")

    files = stream_files(spark, folder, names)
    return (
        (files if kinds is None else closed_sources(files, kinds, wait_ms))
        .writeStream.trigger(**({"availableNow": True} if wait_ms is None else {"processingTime": "10 seconds"}))
        .option("checkpointLocation", checkpoint)
        .foreachBatch(renew)
        .start()
    )
