"""Result ratios per domain, source and day, and what stands out in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SUCCESS, INTERFERENCE = "success", "interference"


def result_counts(rows: DataFrame, by: Sequence[str] = ("domain", "source")) -> DataFrame:
    """Summed ``count`` per key and ``result_type``."""
    return rows.groupBy(*by, "result_type").agg(F.sum("count").alias("count"))


def success_interference_ratios(
    rows: DataFrame, by: Sequence[str] = ("domain", "source")
) -> DataFrame:
    """Success and interference shares per key, over keys that have either.

    Both sides of the comparison are conditional sums of one aggregation.
    """
    relevant = rows.filter(F.col("result_type").isin(SUCCESS, INTERFERENCE))
    sums = relevant.groupBy(*by).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("result_type") == kind, F.col("count"))), F.lit(0)).alias(
                f"{kind}_count"
            )
            for kind in (SUCCESS, INTERFERENCE)
        ]
    )
    total = F.col("success_count") + F.col("interference_count")
    return sums.withColumn("total_count", total).select(
        *by,
        "success_count",
        "interference_count",
        "total_count",
        F.try_divide("success_count", "total_count").alias("success_ratio"),
        F.try_divide("interference_count", "total_count").alias("interference_ratio"),
    )


def daily_ratios(rows: DataFrame) -> DataFrame:
    return success_interference_ratios(rows, ("date", "domain", "source"))


def pivot_success(daily: DataFrame, domain: str, sources: Sequence[str]) -> DataFrame:
    """One row per date, one success ratio per source, for one domain."""
    return (
        daily.filter(F.col("domain") == domain)
        .groupBy("date")
        .pivot("source", list(sources))
        .agg(F.max("success_ratio"))
    )


def pivot_domain_date(daily: DataFrame, value: str, dates: Sequence[str]) -> DataFrame:
    """One row per domain, one ``value`` per date."""
    return daily.groupBy("domain").pivot("date", list(dates)).agg(F.max(value))


def any_over_threshold(daily: DataFrame, threshold: float) -> DataFrame:
    """Domains whose interference exceeds the threshold on some day."""
    flagged = daily.groupBy("domain").agg(
        F.bool_or(F.col("interference_ratio") > threshold).alias("hit")
    )
    return flagged.filter("hit").select("domain")


def all_under_threshold(daily: DataFrame, threshold: float) -> DataFrame:
    """Domains measured on every day and below the threshold on each of them."""
    days = daily.select(F.countDistinct("date").alias("days")).scalar()
    per_domain = daily.groupBy("domain").agg(
        F.bool_and(F.col("interference_ratio") < threshold).alias("calm"),
        F.countDistinct("date").alias("seen"),
    )
    return per_domain.filter(F.col("calm") & (F.col("seen") == days)).select("domain")


def log_normalize(rows: DataFrame, column: str, into: str) -> DataFrame:
    """``(ln x + 0.05 max ln x) / max(...)`` over the whole set."""
    top = rows.select(F.max(F.ln(column)).alias("top")).scalar()
    # The bump is the same for all, so the greatest bumped value is 1.05 times the top.
    return rows.withColumn(into, (F.ln(column) + top * 0.05) / (top * 1.05))


def top_networks(rows: DataFrame, limit: int = 5) -> DataFrame:
    """Networks with the most measurements; ties by number and name."""
    return (
        rows.groupBy("asn", "as_name")
        .agg(F.sum("count").alias("count"))
        .orderBy(F.desc("count"), "asn", "as_name")
        .limit(limit)
    )


def lowest_success(ratios: DataFrame, limit: int = 20) -> DataFrame:
    """Keys with the lowest success ratio, unknown ratios last; ties by key."""
    return ratios.orderBy(F.asc_nulls_last("success_ratio"), "domain", "source").limit(limit)


def scans_of_interest(
    rows: DataFrame, country: str, after: str, before: str, source: str | None = None
) -> DataFrame:
    """Rows of one country in an open date interval, optionally of one source."""
    wanted = (F.col("country") == country) & (F.col("date") > after) & (F.col("date") < before)
    if source is not None:
        wanted = wanted & (F.col("source") == source)
    return rows.filter(wanted)


def sample_rows(rows: DataFrame, n: int = 10) -> DataFrame:
    return rows.limit(n)


def with_label(rows: DataFrame, label: Column) -> DataFrame:
    return rows.withColumn("result_type", label)
