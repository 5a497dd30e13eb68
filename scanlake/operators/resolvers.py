"""How often a resolver fails, over all domains asked of it in a scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.operators.joins import lookup_join

RATES = ("connect_error", "invalid_cert", "non_zero_rcode")


def _failures(rows: DataFrame) -> dict[str, Column]:
    """What went wrong in one row of the DNS table.

    No response code is a failed connection, timeouts included (older formats write -1).
    An answer whose page came with a certificate must have one that is valid for the domain.
    """
    fetched = lambda a: a["https_tls_cert_matches_domain"].isNotNull() | a["https_error"].isNotNull()
    valid = lambda a: F.coalesce(a["https_tls_cert_matches_domain"] & a["https_tls_cert_has_trusted_ca"], F.lit(False))
    rcode = F.col("received_rcode")
    return {
        "connect_error": rcode.isNull() | (rcode < 0),
        "invalid_cert": F.coalesce(F.exists("answers", lambda a: fetched(a) & ~valid(a)), F.lit(False)),
        "non_zero_rcode": F.coalesce(rcode > 0, F.lit(False)),
    }


def resolver_error_rates(rows: DataFrame) -> DataFrame:
    """Per ``source`` and ``resolver_ip`` the share of distinct domains with each kind of error.

    ``rows``: a DNS table. A domain that failed once with a resolver counts as failing.
    Two exact levels: rows are first folded to (source, resolver, domain), which splits a
    resolver that most rows are from over its domains, then domains to resolvers; partial
    aggregates go before both shuffles. Rows without a domain count for nothing.
    """
    flagged = rows.where(F.col("domain").isNotNull()).select("source", "resolver_ip", "domain", *[v.alias(k) for k, v in _failures(rows).items()])
    by_domain = flagged.groupBy("source", "resolver_ip", "domain").agg(*[F.max(k).alias(k) for k in RATES])
    shares = [(F.count_if(F.col(k)) / F.count(F.lit(1))).alias(f"{k}_rate") for k in RATES]
    return by_domain.groupBy("source", "resolver_ip").agg(F.count(F.lit(1)).alias("domains"), *shares)


def fill_error_rates(rows: DataFrame, rates: DataFrame) -> DataFrame:
    """The DNS table with rates where the profile of the resolver has none."""
    joined = lookup_join(rows, rates, ["source", "resolver_ip"])
    filled = {f"resolver_{k}_rate": F.coalesce(f"resolver_{k}_rate", f"{k}_rate") for k in RATES}
    return joined.withColumns(filled).select(*rows.columns)
