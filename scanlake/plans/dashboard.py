"""Base tables to the dashboard table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.operators.reduce import (
    add_unexpected_count,
    capable_domain_semi_join,
    controls_passed,
    join_country_names,
    judge_dns,
    keep_last_retry,
    last_retry,
    project_dns_scan,
    project_probe_scan,
    reduce_scans,
    union_scans,
)
from scanlake.operators.suffixes import registered_domain
from scanlake.sources.sinks import stage

PROBE_SCANS = {"discard": "DISCARD", "echo": "ECHO", "http": "HTTP", "https": "HTTPS"}


def since(table: DataFrame, earliest_date: str | None) -> DataFrame:
    """Rows from a date on; by default from six months ago."""
    if earliest_date is None:
        return table.filter(F.col("date") >= F.add_months(F.current_date(), -6))
    return table.filter(F.col("date") >= F.lit(earliest_date).cast("date"))


def filtered_dns(table: DataFrame, staging: str) -> DataFrame:
    """Last retries of usable resolvers for domains that serve valid certificates.

    Outcome and validity come from one pass over the answers and are written, without the answers, under
    ``staging``; tries, capable domains and counts read them from there. The capable domains, a few, are a
    table as well, so that rows are not shuffled to meet them.
    """
    rows = stage(judge_dns(table), staging)
    capable = stage(rows.filter("has_valid").select("domain", "source").distinct(), staging)
    return keep_last_retry(capable_domain_semi_join(rows.filter("fit"), capable), last_retry(rows))


def build_dashboard(
    tables: dict[str, DataFrame],
    country_names: DataFrame,
    suffixes: DataFrame,
    earliest_date: str | None = None,
    staging: str = "dashboard",
) -> DataFrame:
    """Counts per day, place, network, domain and outcome.

    ``tables``: base tables by scan type (echo, discard, http, https, satellite);
    missing ones are left out. The registered host name depends on the host name
    alone, so it is added after the counting. Judged DNS rows are written once under the
    ``staging`` name, which ``clear_staged`` removes.
    """
    scans = [
        project_probe_scan(since(tables[kind], earliest_date).filter(controls_passed("controls_failed")), label)
        for kind, label in PROBE_SCANS.items()
        if kind in tables
    ]
    if "satellite" in tables:
        scans.append(project_dns_scan(filtered_dns(since(tables["satellite"], earliest_date), staging)))
    grouped = join_country_names(reduce_scans(union_scans(scans)), country_names)
    hosted = registered_domain(grouped, suffixes, "hostname", "reg_hostname")
    return add_unexpected_count(hosted).select(
        "date", "source", "hostname", "reg_hostname", "network", "subnetwork", "domain",
        "category", "outcome", "count", "country_name", "unexpected_count",
    )
