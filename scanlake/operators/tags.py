"""Tag files of a DNS scan: what is known about resolvers and answer addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.functions.paths import source_of
from scanlake.operators.joins import lookup_join
from scanlake.operators.lines import skip_malformed
from scanlake.schemas import ANSWER_TAG_LINE, RESOLVER_TAG_LINE


def country_name_to_code(rows: DataFrame, names: DataFrame, column: str) -> DataFrame:
    """Replace a country name by its code; a name that is not listed stays.

    ``names``: ``country_name``, ``country_code``, one row per name.
    """
    codes = names.select(F.col("country_name").alias(column), "country_code")
    named = lookup_join(rows, codes, [column])
    return named.withColumn(column, F.coalesce("country_code", column)).select(*rows.columns)


def read_resolver_tags(lines: DataFrame, names: DataFrame) -> DataFrame:
    """Resolver tags: source, ip, name, country and five failure rates."""
    scans = skip_malformed(lines, RESOLVER_TAG_LINE)
    rates = [
        F.col(f"scan.{field}").try_cast("double").alias(f"{field}_rate")
        for field in ("non_zero_rcode", "private_ip", "zero_ip", "connect_error", "invalid_cert")
    ]
    ip = F.when(F.col("scan.resolver") != "", F.col("scan.resolver")).otherwise(F.col("scan.vp"))
    tags = scans.select(
        source_of(F.col("file_path")).alias("source"),
        ip.alias("ip"),
        F.col("scan.name").alias("name"),
        F.coalesce("scan.country", "scan.location.country_code").alias("country"),
        *rates,
    )
    return country_name_to_code(tags, names, "country")


def read_answer_tags(lines: DataFrame) -> DataFrame:
    """Answer tags: source, ip, http hash, certificate hash, AS name and number."""
    scans = skip_malformed(lines, ANSWER_TAG_LINE)
    return scans.select(
        source_of(F.col("file_path")).alias("source"),
        F.col("scan.ip").alias("ip"),
        F.col("scan.http").alias("http"),
        F.col("scan.cert").alias("cert"),
        F.col("scan.asname").alias("as_name"),
        F.col("scan.asnum").alias("asn"),
    )
