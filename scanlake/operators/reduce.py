"""Steps from base tables to the dashboard table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.functions.dns import dns_outcome, is_bad_resolver
from scanlake.functions.labels import category_or_default, mask_control_domain, subnetwork_label
from scanlake.functions.outcomes import FAILED, mark_outcome, unexpected_count
from scanlake.operators.barrier import compute_once
from scanlake.operators.joins import lookup_join


def last_retry(rows: DataFrame) -> DataFrame:
    """Highest ``retry`` of each (date, measurement)."""
    return rows.groupBy("date", "measurement_id").agg(F.max("retry").alias("retry"))


def keep_last_retry(rows: DataFrame, last: DataFrame) -> DataFrame:
    """Rows that are the last retry of their measurement; rows without a number stay."""
    marked = last.filter(F.col("retry").isNotNull()).withColumn("is_last", F.lit(True))
    joined = lookup_join(rows, marked, ["date", "measurement_id", "retry"])
    has_key = F.col("date").isNotNull() & F.col("measurement_id").isNotNull()
    return joined.filter((F.col("retry").isNull() & has_key) | F.col("is_last")).select(*rows.columns)


def has_valid_certificate() -> Column:
    return F.exists(
        "answers",
        lambda a: F.coalesce(
            a["https_tls_cert_matches_domain"] & a["https_tls_cert_has_trusted_ca"], F.lit(False)
        ),
    )


def capable_domains(rows: DataFrame) -> DataFrame:
    """(domain, source) with at least one valid certificate among the answers."""
    return rows.filter(has_valid_certificate()).select("domain", "source").distinct()


def capable_domain_semi_join(rows: DataFrame, capable: DataFrame) -> DataFrame:
    marked = capable.withColumn("is_capable", F.lit(True))
    return lookup_join(rows, marked, ["domain", "source"], "inner").select(*rows.columns)


def controls_passed(column: str) -> Column:
    """Not failed; unknown counts as failed."""
    return ~F.col(column)


def good_resolver() -> Column:
    return ~is_bad_resolver(
        F.col("resolver_connect_error_rate"),
        F.col("resolver_invalid_cert_rate"),
        F.col("resolver_non_zero_rcode_rate"),
    )


def bad_resolver_filter(rows: DataFrame) -> DataFrame:
    """Rows of resolvers known to be good; a missing rate drops the row."""
    return rows.filter(good_resolver())


def project_probe_scan(rows: DataFrame, source: str) -> DataFrame:
    """Columns of a probe table that the union needs, with a literal source.

    Marking is cheap, so later filters may repeat it; a barrier would have it interpreted row by row.
    """
    return rows.select(
        F.lit(source).alias("source"),
        "date",
        "server_country",
        "server_as_full_name",
        F.lit(None).cast("string").alias("server_name"),
        "domain_is_control",
        "domain",
        mark_outcome(F.col("outcome")).alias("outcome"),
        "server_asn",
        "server_organization",
        "domain_category",
    )


DNS_DIMENSIONS = [
    "date", "measurement_id", "retry", "source", "domain", "domain_is_control", "domain_category",
    "resolver_country", "resolver_as_full_name", "resolver_name", "resolver_asn", "resolver_organization",
]
_JUDGED = ["received_error", "received_rcode", "answers"]
_JUDGED_FIELDS = [
    "ip", "asn", "as_name", "matches_control", "https_tls_cert_matches_domain", "https_tls_cert_has_trusted_ca",
    "https_tls_cert_issuer", "https_tls_cert_common_name", "http_analysis_is_known_blockpage", "http_analysis_page_signature",
]


def with_dns_outcome(rows: DataFrame) -> DataFrame:
    """What the reduction needs of a DNS table, answers replaced by their outcome.

    Done before any join, so that answers with their pages are never shuffled.
    """
    outcome = dns_outcome(F.col("received_error"), F.col("received_rcode"), F.col("answers"))
    return compute_once(rows.select(*DNS_DIMENSIONS, *_JUDGED), outcome=outcome).drop(*_JUDGED)


def judge_dns(rows: DataFrame) -> DataFrame:
    """All that the dashboard needs of a DNS table, from one pass over its answers.

    ``fit``: the controls passed and the resolver is known to be good; only such rows get an ``outcome``.
    ``has_valid``: one of the answers has a valid certificate.
    """
    fit = F.coalesce(controls_passed("domain_controls_failed") & good_resolver(), F.lit(False))
    outcome = dns_outcome(F.col("received_error"), F.col("received_rcode"), F.col("answers"))
    judged = F.transform("answers", lambda a: F.struct(*[a[n].alias(n) for n in _JUDGED_FIELDS]))
    narrow = rows.select(*DNS_DIMENSIONS, "received_error", "received_rcode", judged.alias("answers"), fit.alias("fit"))
    valid = F.coalesce(has_valid_certificate(), F.lit(False))
    return compute_once(narrow, outcome=F.when(F.col("fit"), outcome), has_valid=valid).drop(*_JUDGED)


def project_dns_scan(rows: DataFrame) -> DataFrame:
    """Columns of the DNS scan that the union needs; ``rows`` have their outcome."""
    return rows.select(
        F.lit("DNS").alias("source"),
        "date",
        F.col("resolver_country").alias("server_country"),
        F.col("resolver_as_full_name").alias("server_as_full_name"),
        F.col("resolver_name").alias("server_name"),
        "domain_is_control",
        "domain",
        "outcome",
        F.col("resolver_asn").alias("server_asn"),
        F.col("resolver_organization").alias("server_organization"),
        "domain_category",
    )


def union_scans(scans: list[DataFrame]) -> DataFrame:
    whole = scans[0]
    for scan in scans[1:]:
        whole = whole.unionByName(scan)
    return whole


def reduce_scans(rows: DataFrame) -> DataFrame:
    """Counts per dimension; failed set-ups and read errors are left out first."""
    kept = rows.filter(
        ~F.col("outcome").startswith(FAILED + "setup/") & (F.col("outcome") != FAILED + "read/system")
    )
    dimensions = kept.select(
        "date",
        "source",
        F.col("server_country").alias("country_code"),
        F.col("server_name").alias("hostname"),
        F.col("server_as_full_name").alias("network"),
        subnetwork_label(F.col("server_asn"), F.col("server_organization")).alias("subnetwork"),
        mask_control_domain(F.col("domain"), F.col("domain_is_control")).alias("domain"),
        category_or_default(F.col("domain_category")).alias("category"),
        "outcome",
    )
    return dimensions.groupBy(*dimensions.columns).agg(F.count("*").alias("count"))


def join_country_names(rows: DataFrame, names: DataFrame) -> DataFrame:
    """Country name for ``country_code``, or the code itself; rows without a code go.

    ``names``: ``country_code``, ``country_name``, one row per code.
    """
    located = rows.filter(F.col("country_code").isNotNull())
    return (
        lookup_join(located, names.select("country_code", "country_name"), ["country_code"])
        .withColumn("country_name", F.coalesce("country_name", "country_code"))
        .drop("country_code")
    )


def add_unexpected_count(rows: DataFrame) -> DataFrame:
    return rows.withColumn("unexpected_count", unexpected_count(F.col("outcome"), F.col("count")))
