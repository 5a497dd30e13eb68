"""Writing tables and exports."""

from __future__ import annotations

import gc
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from scanlake.operators.tables import export_projection
from scanlake.session import shared_folder


#: Rows of a range that is sorted in one task.
RANGE_ROWS = 500_000


class EmptyResult(ValueError):
    """No rows came out of a load although there were files to read."""


def _cluster_columns(table: DataFrame) -> list[str]:
    side = "resolver" if "resolver_country" in table.columns else "server"
    return [f"{side}_country", f"{side}_asn"]


def write_base_table(table: DataFrame, path: str, append: bool = False, partitions: int | None = None) -> None:
    """Write a table partitioned by date and clustered by country and network across files.

    Rows are dealt out by ranges of (date, country, network), with bounds from a sample, and
    sorted so inside files: the files of a large day follow each other by country and overlap
    at most with their neighbours, small days share a task, and readers skip files by minimum
    and maximum. There are ``partitions`` ranges, or more where one would hold over
    ``RANGE_ROWS`` rows, so that what a task sorts does not grow with the table. Count and
    sample read the rows once more each, so they had better be a table already.
    """
    order = ["date", *[c for c in _cluster_columns(table) if c in table.columns]]
    least = -(-table.count() // RANGE_ROWS)
    if partitions is None and least > int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        partitions = least
    dealt = table.repartitionByRange(max(partitions, least), *order) if partitions else table.repartitionByRange(*order)
    arranged = dealt.sortWithinPartitions(*order)
    arranged.write.mode("append" if append else "overwrite").partitionBy("date").parquet(path)


def observed(rows: DataFrame, *metrics) -> tuple[DataFrame, Observation]:
    """Rows that report aggregates of themselves when an action runs over them."""
    observation = Observation()
    return rows.observe(observation, *metrics), observation


def counts_of(observation: Observation, *names: str) -> list[int]:
    """Counts that an action reported; zeros if it had no rows at all.

    Adaptive execution replaces a plan that turns out empty by an empty relation, and the
    node that counts goes with it; the report is then an empty row, which cannot be read.
    """
    try:
        found = observation.get
    except Py4JJavaError as error:
        if "PythonSQLUtils.toPyRow" not in str(error):
            raise
        found = {}
    return [found.get(name) or 0 for name in names]


def fail_if_empty(table: DataFrame, path: str, append: bool = False) -> int:
    """Write a table, counting on the way; an empty result is an error. Returns the count.

    The rows are staged first, which works them out and counts them once.
    """
    spark, name = table.sparkSession, f"counted-{uuid.uuid4().hex}"
    counted, observation = observed(table, F.count(F.lit(1)).alias("rows"))
    try:
        staged = stage(counted, name)
        (rows,) = counts_of(observation, "rows")
        if rows == 0:
            raise EmptyResult("zero rows were created although there were new files")
        write_base_table(staged, path, append)
    finally:
        clear_staged(spark, name)
    return rows


def write_json_export(table: DataFrame, path: str) -> None:
    """Gzip JSON under ``source=…/country=…``; both columns also stay in the records.

    A missing country becomes the folder ``country=None``. A large folder gets
    several files. Exporting a source again replaces its folders and no others.
    """
    country = _cluster_columns(table)[0]
    exported = export_projection(table)
    keyed = exported.withColumns(
        {
            "__source": F.col("source"),
            "__country": F.coalesce(country, F.lit("None")),
        }
    )
    # Partition columns leave the record, so they are copies under the folder names.
    records = keyed.select(
        F.to_json(F.struct(*exported.columns), {"ignoreNullFields": "false"}).alias("value"),
        F.col("__source").alias("source"),
        F.col("__country").alias("country"),
    )
    (
        records.hint("rebalance", "source", "country")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source", "country")
        .option("compression", "gzip")
        .text(path)
    )


def csv_export(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", "true").csv(path)


def stage(rows: DataFrame, name: str, folder: str | None = None, compression: str | None = None) -> DataFrame:
    """Write rows to the shared folder and read them back.

    Several later steps read different columns of the flattened rows; a written
    table spares parsing the raw lines again for each and survives lost executors.
    Every call has a folder of its own, so two loads under one name never meet;
    ``clear_staged`` removes those of a name.
    """
    spark: SparkSession = rows.sparkSession
    path = f"{folder or shared_folder(spark)}/{name}/{uuid.uuid4().hex}"
    rows.write.parquet(path, compression=compression)
    return spark.read.schema(rows.schema).parquet(path)


def let_go(spark: SparkSession) -> None:
    """Remove the shuffle files of finished steps now; Spark keeps them until the driver's heap is collected."""
    gc.collect()
    spark._jvm.System.gc()


def clear_staged(spark: SparkSession, name: str, folder: str | None = None) -> bool:
    """Remove what was staged under a name, when no table read from it is used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder or shared_folder(spark)}/{name}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def publish_table(table: DataFrame, name: str, version: str, path: str | None = None) -> None:
    """Save a versioned table and point the stable view at it."""
    ordered = ["source", "country_name", "domain", "network"]
    arranged = table.hint("rebalance", "date").sortWithinPartitions("date", *ordered)
    writer = arranged.write.mode("overwrite").partitionBy("date").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(f"{name}_{version}")
    table.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {name}_{version}")
