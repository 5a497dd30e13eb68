"""Side files: routes, organisations, AS types, categories, countries, signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.operators.signatures import Signature, refuse_unsupported
from scanlake.operators.snapshots import snapshot_file_date

SIGNATURE_BYTES = 8 << 20


def line_order() -> Column:
    """Place of a line among all lines of files that are read: by file, block and row."""
    return F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id())


def last_line_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row per key, the one that comes last; a lookup made of it never multiplies rows."""
    values = [c for c in rows.columns if c not in (*keys, order)]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), F.col(order)).alias("last"))
    return last.select(*keys, "last.*")


def read_prefix_table(spark: SparkSession, paths) -> DataFrame:
    """Route files (``network <tab> length <tab> asn``) with the snapshot date of their name.

    A route announced by several systems keeps the first number.
    """
    rows = spark.read.csv(paths, sep="\t", schema="network STRING, len INT, origin STRING")
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1)
    return rows.select(
        snapshot_file_date(name).alias("snapshot"),
        "network",
        "len",
        F.regexp_extract("origin", r"^(\d+)", 1).try_cast("bigint").alias("asn"),
    )


def parse_two_section_file(lines: DataFrame) -> DataFrame:
    """AS number to name, organisation and country from a file of two tables.

    ``lines``: ``value`` and, if they are not in order, ``line``. Organisations have five
    ``|`` separated fields, AS numbers six, so every line says itself which table it
    belongs to and the file can be split anywhere. Of a repeated organisation or AS
    number the last line counts; a missing organisation leaves name and country null.
    """
    order = F.col("line") if "line" in lines.columns else F.monotonically_increasing_id()
    fields = lines.select(F.split("value", r"\|").alias("f"), order.alias("line")).filter(~F.col("f")[0].startswith("#"))
    orgs = fields.filter(F.size("f") == 5).select(
        F.col("f")[0].alias("org_id"), F.col("f")[2].alias("as_full_name"), F.col("f")[3].alias("country"), "line"
    )
    numbers = fields.filter(F.size("f") == 6).select(
        F.col("f")[0].try_cast("bigint").alias("asn"),
        F.col("f")[2].alias("as_name"),
        F.col("f")[3].alias("org_id"),
        "line",
    )
    numbers, orgs = last_line_wins(numbers, ["asn"], "line"), last_line_wins(orgs, ["org_id"], "line")
    return numbers.join(orgs, "org_id", "left").select("asn", "as_name", "as_full_name", "country")


def read_as_types(spark: SparkSession, paths) -> DataFrame:
    """AS number to network type (``asn|source|type``, ``#`` comments); the last line of a number counts."""
    rows = spark.read.csv(paths, sep="|", comment="#", schema="asn BIGINT, origin STRING, as_class STRING")
    return last_line_wins(rows.select("asn", "as_class", line_order().alias("line")), ["asn"], "line")


def read_categories(spark: SparkSession, paths) -> DataFrame:
    """Domain to category; the last line of a domain counts."""
    rows = spark.read.csv(paths, schema="domain STRING, category STRING")
    return last_line_wins(rows.select("*", line_order().alias("line")), ["domain"], "line")


def read_country_names(spark: SparkSession, paths) -> DataFrame:
    """Country name of each code; the last line of a code counts."""
    rows = spark.read.csv(paths, schema="country_name STRING, country_code STRING")
    return last_line_wins(rows.select("*", line_order().alias("line")), ["country_code"], "line").select("country_name", "country_code")


def read_org_ranges(spark: SparkSession, paths) -> DataFrame:
    return spark.read.csv(paths, schema="start_ip BIGINT, end_ip BIGINT, org STRING, asn BIGINT")


def read_ranked_lists(spark: SparkSession, paths_by_rank: list[str]) -> DataFrame:
    """Category lists in order of rank, with their line numbers.

    A list is one small file; its line number is the running id within the file.
    """
    whole = None
    for rank, path in enumerate(paths_by_rank):
        rows = spark.read.csv(path, schema="url STRING, code STRING, category STRING")
        ranked = rows.select(
            F.lit(rank).alias("rank"), F.monotonically_increasing_id().alias("line"), "url", "category"
        )
        whole = ranked if whole is None else whole.unionByName(ranked)
    return whole


def read_signatures(spark: SparkSession, path: str) -> list[Signature]:
    """Signatures in file order; blank lines are skipped, a repeated fingerprint keeps
    its place and takes the later pattern.

    Lines are read and folded by fingerprint on the executors, so the file may be large and
    may be a folder of files. What is left becomes literals of the plan, like the rules in
    code, and goes to the driver; more than ``SIGNATURE_BYTES`` of it is refused before it
    is fetched. A pattern that cannot be searched is refused by its fingerprint.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    item = F.from_json("value", "fingerprint STRING, pattern STRING", {"mode": "FAILFAST"})
    rows = lines.select(line_order().alias("line"), "value").where(F.col("value").rlike(r"(?U)\S")).select("line", "value", item.alias("item"))
    whole = F.col("item.fingerprint").isNotNull() & F.col("item.pattern").isNotNull()
    lacking = F.raise_error(F.concat(F.lit("no fingerprint or pattern: "), F.col("value"))).cast("string")
    rows = rows.select("line", F.when(whole, F.col("item.fingerprint")).otherwise(lacking).alias("fingerprint"), "item.pattern")
    folded = rows.groupBy("fingerprint").agg(F.min("line").alias("first"), F.max_by("pattern", "line").alias("pattern"))
    size = folded.agg(F.sum(F.octet_length("fingerprint") + F.octet_length("pattern"))).first()[0] or 0
    if size > SIGNATURE_BYTES:
        raise ValueError(f"{path} has {size} bytes of signatures; there may be {SIGNATURE_BYTES}")
    signatures = [Signature(r["pattern"], r["fingerprint"]) for r in folded.orderBy("first").select("pattern", "fingerprint").collect()]
    refuse_unsupported(spark, signatures)
    return signatures


def completeness_check(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """Distinct measurements of each expected ``source`` against its expected ``count``."""
    found = rows.groupBy("source").agg(F.countDistinct("measurement_id").alias("found"))
    joined = expected.select("source", F.col("count").alias("expected")).join(found, "source", "left")
    return joined.select(
        "source",
        "expected",
        F.coalesce("found", F.lit(0)).alias("found"),
        (F.col("expected") == F.coalesce("found", F.lit(0))).alias("complete"),
    )
