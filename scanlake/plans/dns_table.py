"""Raw lines of a DNS scan to the DNS table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from scanlake.functions.text import url_host
from scanlake.operators.answers import (
    answer_sets,
    enrich_answers,
    join_resolver_facts,
)
from scanlake.operators.categories import categorize_domain
from scanlake.operators.certificates import enrich_certificates
from scanlake.operators.dns import flatten_dns
from scanlake.operators.joins import lookup_join
from scanlake.operators.lines import (
    ANSWER_TAGS,
    OBSERVATIONS,
    PAGE_FETCHES,
    RESOLVER_TAGS,
    DeadLetters,
    route_by_filename,
)
from scanlake.operators.pages import flatten_page_fetch
from scanlake.operators.postprocess import postprocess
from scanlake.operators.tables import dns_table
from scanlake.operators.tags import read_answer_tags, read_resolver_tags
from scanlake.plans.probe_table import ReferenceData, match_pages
from scanlake.sources.sinks import stage


def page_fetch_rows(lines: DataFrame, data: ReferenceData) -> DataFrame:
    """Page fetches with signature and certificate fields; every fetch is suspect."""
    fetched = match_pages(
        flatten_page_fetch(lines), F.lit(True) & (F.col("received.status").isNotNull()), data
    )
    return enrich_certificates(fetched, data.certificates)


def build_dns_table(
    lines: DataFrame, data: ReferenceData, staging: str = "dns", counts: Observation | None = None,
    dead: DeadLetters | None = None,
) -> DataFrame:
    """DNS table of the ``file_path``, ``value`` lines of all files of a scan.

    The flattened rows feed the lookups and the control counts besides the table itself, so
    they are written once, under the ``staging`` name, and read back; ``counts`` gets lines
    and malformed lines of measurements, ``dead`` keeps the latter. Lookups are made for the
    distinct domains, resolvers and sets of answers that occur, and are tables whose size is
    known when the rows meet them: the rows move only where what is in use of one is large.
    """
    kinds = route_by_filename(lines)
    rows = stage(flatten_dns(kinds[OBSERVATIONS], counts, dead), staging)
    fetches = stage(page_fetch_rows(kinds[PAGE_FETCHES], data), staging)
    places = stage(rows.select("source", "date", "ip").distinct(), staging)
    sets = stage(answer_sets(rows), staging)
    addresses = places.select("date", "ip").union(sets.select("date", F.explode("ips").alias("ip"))).distinct()
    lookup = stage(data.ip_lookup(stage(addresses, staging)), staging)
    tags = read_resolver_tags(kinds[RESOLVER_TAGS], data.country_names)

    hosts = rows.select(url_host(F.col("domain")).alias("domain")).distinct()
    categories = stage(lookup_join(hosts, data.categories.select("domain", "category"), ["domain"], "inner"), staging)
    rows = categorize_domain(rows, categories)
    rows = join_resolver_facts(rows, places, tags, lookup, staging)
    rows = enrich_answers(rows, read_answer_tags(kinds[ANSWER_TAGS]), lookup, fetches, staging, sets)
    # Read twice: for the few rows of controls, which are filtered where the table is scanned, and as a whole.
    return dns_table(postprocess(rows, staging))
