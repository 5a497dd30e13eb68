"""From a folder of raw files to the base table: choose, read, build, count, write."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from scanlake.functions.paths import source_of
from scanlake.operators.lines import DeadLetters
from scanlake.plans.dns_table import build_dns_table
from scanlake.plans.probe_table import ReferenceData, build_probe_table
from scanlake.sources.files import list_files, read_lines, select_input_files
from scanlake.sources.publication import Log, published_sources
from scanlake.sources.sinks import clear_staged, counts_of, observed

DNS = "satellite"


class LoadReport(NamedTuple):
    """What a load read and wrote; lines are those of measurements."""

    files: int
    lines: int
    malformed: int
    rows: int
    rows_with_metadata: int


def load_scan(
    spark: SparkSession,
    folder: str,
    scan_type: str,
    data: ReferenceData,
    table: str,
    export: str | None = None,
    start: str | None = None,
    end: str | None = None,
    dead_letters: str | None = None,
) -> LoadReport:
    """Add the sources of ``folder`` that ``table`` does not have yet, and export them.

    Files are chosen by type, date and name; no new file is no work, new files without
    a single row are an error. Table and export get a load together (``publication``); one
    that an earlier run left between the two is finished first. Lines that cannot be parsed
    are appended to the ``dead_letters`` table, if one is named. Staged rows lie in folders
    of this call alone and are removed at its end, also after an error.
    """
    log = Log(spark, table)
    log.finish()
    chosen = select_input_files(list_files(spark, folder), scan_type, start, end, published_sources(spark, table))
    paths = [row["path"] for row in chosen.select("path").toLocalIterator()]  # a file listing, as any read has one
    if not paths:
        return LoadReport(0, 0, 0, 0, 0)
    listed = spark.createDataFrame([(p,) for p in paths], "path STRING")
    sources = [row["source"] for row in listed.select(source_of(F.col("path")).alias("source")).distinct().toLocalIterator()]
    counts, staging = Observation(), f"load-{scan_type}-{uuid.uuid4().hex}"
    build = build_dns_table if scan_type == DNS else build_probe_table
    number = "resolver_asn" if scan_type == DNS else "server_asn"
    try:
        dead = DeadLetters(dead_letters, staging) if dead_letters else None
        built = build(read_lines(spark, paths), data, staging=staging, counts=counts, dead=dead)
        built, located = observed(built, F.count_if(F.col(number).isNotNull()).alias("rows_with_metadata"))
        load = log.stage(built, sorted(sources), export)
    finally:
        clear_staged(spark, staging)
    log.publish(load)
    return LoadReport(len(paths), *counts_of(counts, "lines", "malformed"), load.rows, *counts_of(located, "rows_with_metadata"))
