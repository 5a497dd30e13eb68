"""Raw scan files: listing, choosing and reading them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.constants import DNS_FILES, EARLIEST_DNS_FILE, EMPTY_GZIP_BYTES, PROBE_FILES
from scanlake.functions.paths import between_dates, filename_matches, source_of


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``path`` and ``length`` of every file below a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "length")
    )


def select_input_files(
    files: DataFrame,
    scan_type: str,
    start: str | None = None,
    end: str | None = None,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Files of a scan type worth loading.

    In the date range, of a known name, not empty, and of a ``source`` that is not
    in ``loaded``. DNS files are never older than the fixed earliest date.
    """
    names = PROBE_FILES
    if scan_type == "satellite":
        names = DNS_FILES
        start = max(start or EARLIEST_DNS_FILE, EARLIEST_DNS_FILE)
    chosen = files.filter(
        between_dates(F.col("path"), start, end)
        & filename_matches(F.col("path"), names)
        & (F.col("length") > EMPTY_GZIP_BYTES)
    )
    return chosen if loaded is None else new_sources(chosen, loaded)


def new_sources(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files whose source has not been loaded yet."""
    named = files.withColumn("source", source_of(F.col("path")))
    return named.join(loaded.select("source").distinct(), "source", "left_anti").select(*files.columns)


def existing_sources(table: DataFrame) -> DataFrame:
    return table.select("source").distinct()


def exported_sources(files: DataFrame) -> DataFrame:
    """Sources named by ``source=…`` in export paths."""
    name = F.regexp_extract("path", r"source=([^/]*)", 1)
    return files.filter(F.col("path").contains("source=")).select(name.alias("source")).distinct()


def reconcile_sources(table: DataFrame, export: DataFrame) -> DataFrame:
    """Sources that only one of the two targets has, and which one misses them."""
    left = existing_sources(table).withColumn("in_table", F.lit(True))
    right = existing_sources(export).withColumn("in_export", F.lit(True))
    both = left.join(right, "source", "full_outer")
    missing = (
        F.when(F.col("in_export").isNull(), "export").when(F.col("in_table").isNull(), "table")
    )
    return both.select("source", missing.alias("missing_in")).filter(F.col("missing_in").isNotNull())


def require_reconciled(table: DataFrame, export: DataFrame) -> None:
    """Fail when the two targets do not hold the same sources."""
    counts = reconcile_sources(table, export).groupBy("missing_in").count().collect()  # two rows at most
    if counts:
        told = ", ".join(f"{r['count']} sources missing in {r['missing_in']}" for r in sorted(counts))
        raise ValueError(f"targets differ: {told}; reconcile_sources lists them")


def read_lines(spark: SparkSession, paths: str | Sequence[str], partitions: int | None = None) -> DataFrame:
    """Lines of plain or gzip text with the path of their file.

    A gzip file is read by one task, so lines are dealt out evenly afterwards.
    """
    lines = spark.read.text(paths, recursiveFileLookup=True).select(
        F.col("_metadata.file_path").alias("file_path"), "value"
    )
    lines = lines.filter(F.col("value") != "")
    return lines.repartition(partitions) if partitions else lines.hint("rebalance")
