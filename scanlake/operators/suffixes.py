"""Registered domain of a host: its public suffix and one label more."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.operators.joins import lookup_join

SPECIAL = "special"


def registered_domain(rows: DataFrame, suffixes: DataFrame, column: str, into: str) -> DataFrame:
    """Add the registered domain of the host in ``column`` as ``into``.

    ``suffixes``: ``rule``, the lines of a public suffix list (``co.uk``, ``*.ck``,
    ``!www.ck``). The longest rule wins, an exception beats it, a host without a
    rule has its last label as suffix. "special" is kept; a bare suffix gives null.
    Each distinct host is matched once, by equality on its label suffixes.
    """
    hosts = rows.select(F.col(column).alias("host")).filter(F.col("host").isNotNull()).distinct()
    labels = F.split(F.lower(F.regexp_replace("host", r"\.$", "")), r"\.")
    tails = hosts.select("host", labels.alias("labels")).select(
        "host",
        F.size("labels").alias("size"),
        F.explode(F.sequence(F.lit(1), F.size("labels"))).alias("n"),
        "labels",
    )
    rules = suffixes.select(
        F.regexp_replace(F.lower("rule"), r"^(!|\*\.)", "").alias("tail"),
        # Labels the rule adds to its plain tail: a wildcard one more, an exception one less.
        F.when(F.col("rule").startswith("!"), -1).when(F.col("rule").startswith("*."), 1).otherwise(0).alias("extra"),
    ).distinct()
    matched = tails.withColumn(
        "tail", F.array_join(F.slice("labels", F.col("size") - F.col("n") + 1, F.col("n")), ".")
    ).join(rules, "tail")
    best = (
        matched.filter(F.col("n") + F.col("extra") <= F.col("size"))
        .groupBy("host")
        .agg(
            F.max(F.when(F.col("extra") == -1, F.col("n") - 1)).alias("exception"),
            F.max(F.when(F.col("extra") >= 0, F.col("n") + F.col("extra"))).alias("longest"),
        )
        .select(F.col("host").alias(column), F.coalesce("exception", "longest").alias("suffix_size"))
    )
    joined = lookup_join(rows, best, [column])
    parts = F.split(F.regexp_replace(column, r"\.$", ""), r"\.")
    wanted = F.coalesce("suffix_size", F.lit(1)) + 1
    name = F.when(
        F.size(parts) >= wanted,
        F.array_join(F.slice(parts, F.size(parts) - wanted + 1, wanted), "."),
    )
    return joined.select(
        *[c for c in rows.columns],
        F.when(F.col(column) == SPECIAL, F.lit(SPECIAL)).otherwise(name).alias(into),
    )
