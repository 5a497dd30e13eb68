"""Confidence and exclusion of DNS test rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.constants import CDN_NAME_PREFIXES
from scanlake.operators.joins import lookup_join
from scanlake.sources.sinks import stage


def count_tags(answer: Column) -> Column:
    """How many of the four tags an answer has."""
    metadata = answer["ip_metadata"]
    tags = F.array(
        answer["http"], answer["cert"], metadata["asn"].cast("string"), metadata["as_name"]
    )
    return F.size(F.filter(tags, lambda tag: tag.isNotNull()))


def row_role() -> Column:
    """``domain_control``, ``resolver_control`` or ``test``."""
    resolver_control = F.coalesce(F.col("is_control_ip"), F.lit(False)) | F.col("anomaly").isNull()
    return (
        F.when(F.coalesce(F.col("is_control"), F.lit(False)), "domain_control")
        .when(resolver_control, "resolver_control")
        .otherwise("test")
    )


def max_control_tags(rows: DataFrame) -> DataFrame:
    """Most tags of any resolver control, per (source, domain). The last answer counts."""
    last = F.try_element_at("received", F.lit(-1))
    controls = rows.filter(row_role() == "resolver_control")
    total = F.when(F.size("received") > 0, count_tags(last)).otherwise(0)
    return (
        controls.select("source", "domain", total.alias("tags"))
        .groupBy("source", "domain")
        .agg(F.max("tags").alias("control_tags"))
    )


def broadcast_control_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Add ``control_tags`` to every row, 0 where no control was measured."""
    joined = lookup_join(rows, counts, ["source", "domain"])
    return joined.withColumn("control_tags", F.coalesce("control_tags", F.lit(0)))


def answer_confidence(answer: Column) -> Column:
    """Percentage of an answer's tags that the controls share; 100 for a shared address."""
    flags = answer["matches_control"]
    total = count_tags(answer)
    matching = F.size(
        F.filter(
            F.array(flags["http"], flags["cert"], flags["asnum"], flags["asname"]), lambda f: f
        )
    )
    return (
        F.when(flags["ip"], F.lit(100.0))
        .when(total == 0, F.lit(0.0))
        .otherwise(matching * F.lit(100.0) / total)
    )


def dns_confidence(rows: DataFrame, applies: Column | None = None) -> DataFrame:
    """Set confidences and untagged flags; an untagged response is no anomaly.

    ``rows`` has ``control_tags``, which is dropped. Rows that ``applies`` is not true
    for keep their values.
    """
    applies = F.lit(True) if applies is None else applies

    def set_where(frame: DataFrame, name: str, value: Column) -> DataFrame:
        return frame.withColumn(name, F.when(applies, value).otherwise(F.col(name)))

    untagged = ~F.exists("received", lambda a: count_tags(a) > 0)
    total = F.aggregate(
        "received", F.lit(0.0), lambda so_far, a: so_far + a["match_confidence"]
    )
    average = F.when(F.size("received") > 0, total / F.size("received")).otherwise(0.0)
    rows = set_where(
        rows,
        "received",
        F.transform("received", lambda a: a.withField("match_confidence", answer_confidence(a))),
    )
    rows = set_where(rows, "average_confidence", average)
    rows = set_where(rows, "untagged_controls", F.col("control_tags") == 0)
    rows = set_where(rows, "untagged_response", untagged)
    rows = set_where(
        rows, "anomaly", F.when(F.col("untagged_response"), False).otherwise(F.col("anomaly"))
    )
    return rows.drop("control_tags")


def exclude_cdn(rows: DataFrame, applies: Column | None = None) -> DataFrame:
    """Mark anomalous rows that point to a content network as false positives."""
    applies = F.lit(True) if applies is None else applies
    pattern = "^(" + "|".join(CDN_NAME_PREFIXES) + ")"
    matches = F.size(F.filter("received", lambda a: a["ip_metadata"]["as_name"].rlike(pattern)))
    anomalous = F.coalesce(F.col("anomaly"), F.lit(False))
    excluded = F.when(anomalous, matches > 0)
    reason = F.when(anomalous, F.array_join(F.array_repeat(F.lit("is_CDN"), matches), " "))
    return rows.withColumns(
        {
            "excluded": F.when(applies, excluded).otherwise(F.col("excluded")),
            "exclude_reason": F.when(applies, reason).otherwise(F.col("exclude_reason")),
        }
    )


def postprocess(rows: DataFrame, staging: str | None = None) -> DataFrame:
    """Rate and verify the test rows in one pass; control rows stay as they are.

    The counts of controls are staged under ``staging``, if given: the rows are not shuffled to meet a small table.
    """
    counts = max_control_tags(rows)
    counted = broadcast_control_counts(rows, counts if staging is None else stage(counts, staging))
    is_test = F.col("is_test")
    marked = counted.withColumn("is_test", row_role() == "test")
    return exclude_cdn(dns_confidence(marked, is_test), is_test).select(*rows.columns)
