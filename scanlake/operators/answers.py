"""Enrichment of resolver addresses and of the answers inside DNS rows.

What is found for the answers of a row depends on its source, domain, date and answer
addresses alone; a single lookup depends on fewer of them still. Enrichment keeps one of each
such set of answers, explodes its keys (set, place, lookup keys), joins these narrow records
with every side table, regroups what was found by set, and joins it back once: rows with
their answers, however wide, are moved a single time, and not at all where the sets are few.
Rows are read twice for that, for the sets and for the join back; rows that are no table yet
are staged first, so that they are worked out once. What was found is staged too, so that its
size is known before rows are shuffled to meet it and the shuffles it took are gone by then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.constants import DNS_V2_2_START, DNS_V2_START
from scanlake.functions.records import ip_metadata, merge_ip_metadata
from scanlake.operators.barrier import explode_once
from scanlake.operators.ip_metadata import join_row_ip_metadata
from scanlake.operators.joins import lookup_join
from scanlake.sources.sinks import let_go, stage

ROW_KEY = ("measurement_id", "roundtrip")
SET_KEY = "answer_set"
#: Columns that decide, with the addresses, what any lookup finds.
DECISIVE = ("source", "domain", "date")
#: Name under which rows are staged; ``clear_staged`` removes them once the result is written.
STAGING = "answers"
_RESOLVER_FIELDS = [
    "name", "country", "non_zero_rcode_rate", "private_ip_rate", "zero_ip_rate",
    "connect_error_rate", "invalid_cert_rate",
]


def join_resolver_tags(rows: DataFrame, tags: DataFrame) -> DataFrame:
    """Merge resolver tags into ``ip_metadata`` by (source, ip).

    A resolver may have several tag rows; of several values of one field the
    greatest is used, so that the result does not depend on row order.
    """
    merged = tags.groupBy("source", "ip").agg(
        *[F.max(name).alias(f"tag_{name}") for name in _RESOLVER_FIELDS]
    )
    joined = lookup_join(rows, merged, ["source", "ip"])
    metadata = F.col("ip_metadata")
    for name in _RESOLVER_FIELDS:
        metadata = metadata.withField(name, F.coalesce(f"tag_{name}", f"ip_metadata.{name}"))
    return joined.withColumn("ip_metadata", metadata).select(*rows.columns)


def join_resolver_facts(rows: DataFrame, places: DataFrame, tags: DataFrame, lookup: DataFrame, staging: str) -> DataFrame:
    """Tags and address metadata of resolvers, found once per (source, date, ip) and joined in one step.

    ``places`` holds the ``source``, ``date`` and ``ip`` of all rows, as a table. Metadata goes before tags, and
    tags before what the row has. Dates and sources may be null, so the key is a record of the three. What is
    found is staged under ``staging``: the size of a table is known before rows are shuffled to meet it.
    """
    place = F.when(F.col("ip").isNotNull(), F.struct("source", "date", "ip"))
    resolvers = places.select("source", "date", "ip").filter(F.col("ip").isNotNull()).distinct()
    found = join_row_ip_metadata(join_resolver_tags(resolvers.withColumn("ip_metadata", ip_metadata()), tags), lookup)
    facts = stage(found.select(place.alias("place"), F.col("ip_metadata").alias("facts")), staging)
    joined = lookup_join(rows.withColumn("place", place), facts, ["place"])
    return joined.withColumn("ip_metadata", merge_ip_metadata(F.col("ip_metadata"), F.col("facts"))).select(*rows.columns)


def explode_answers(rows: DataFrame, row_key: tuple[str, ...] = ROW_KEY) -> DataFrame:
    """One record per answer, with the row it came from; rows without answers stay."""
    carried = [c for c in rows.columns if c != "received" and c not in row_key]
    return rows.select(
        *row_key,
        F.struct(*carried).alias("row"),
        F.posexplode_outer("received").alias("position", "answer"),
    )


def regroup_answers(answers: DataFrame, row_key: tuple[str, ...] = ROW_KEY) -> DataFrame:
    """Rows with their answers in their old places: inverse of ``explode_answers``.

    The row key fixes the whole content of a row, so copies of a row yield equal
    answers. A set per key keeps one of each, before the shuffle already, and the
    number of copies is restored at the end: no group outgrows the answers of one row.
    """
    first = F.col("position").isNull() | (F.col("position") == 0)
    grouped = answers.groupBy(*row_key).agg(
        F.any_value("row").alias("row"),
        F.collect_set(
            F.when(F.col("position").isNotNull(), F.struct("position", "answer"))
        ).alias("placed"),
        F.sum(F.when(first, 1).otherwise(0)).alias("copies"),
    )
    received = F.transform(F.array_sort("placed"), lambda p: p["answer"])
    return grouped.select(
        *row_key,
        "row.*",
        received.alias("received"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy"),
    ).drop("copy")


def answer_set(by: tuple[str, ...] = DECISIVE, where: Column | None = None) -> Column:
    """Digest of all that decides what is found for the answers of a row; null without answers or beside ``where``.

    Half of a SHA-256, as bytes: it travels with every row, and does not compress.
    """
    decisive = F.struct(*by, F.col("received.ip").alias("ips"))
    return F.when(_answered(where), F.unhex(F.substring(F.sha2(F.to_json(decisive), 256), 1, 32)))


def _answered(where: Column | None) -> Column:
    some = F.size("received") > 0
    return some if where is None else some & where


def answer_sets(rows: DataFrame, by: tuple[str, ...] = DECISIVE, where: Column | None = None) -> DataFrame:
    """Distinct sets of answers: ``answer_set``, the columns ``by`` and the addresses ``ips``."""
    return rows.filter(_answered(where)).select(answer_set(by).alias(SET_KEY), *by, F.col("received.ip").alias("ips")).distinct()


def answer_keys(sets: DataFrame) -> DataFrame:
    """Set, place and lookup keys of every answer, without the answer itself."""
    placed = explode_once(sets, [c for c in sets.columns if c != "ips"], F.col("ips"), "position", "ip")
    return placed.filter(F.col("ip").isNotNull())


def has_tags() -> Column:
    """Dated before the format whose answers have their tags."""
    return F.col("date") < DNS_V2_2_START


def has_fetches() -> Column:
    return F.col("date") >= DNS_V2_START


def _if_dated(keys: DataFrame, fits: Column) -> Column | None:
    """Keys without a date are those of dates that fit."""
    return fits if "date" in keys.columns else None


def find_tags(keys: DataFrame, tags: DataFrame) -> DataFrame:
    """Answer tags by (source, answer ip), for answers dated before the format that has them."""
    names = ("http", "cert", "as_name", "asn")
    merged = tags.groupBy("source", "ip").agg(*[F.max(n).alias(n) for n in names])
    merged = merged.select("source", "ip", F.struct(*names).alias("tag"))
    return lookup_join(keys, merged, ["source", "ip"], condition=_if_dated(keys, has_tags()))


def merge_tags(answer: Column, found: Column) -> Column:
    tag = found["tag"]
    metadata = (
        answer["ip_metadata"]
        .withField("as_name", F.coalesce(tag["as_name"], answer["ip_metadata"]["as_name"]))
        .withField("asn", F.coalesce(tag["asn"], answer["ip_metadata"]["asn"]))
    )
    return (
        answer.withField("http", F.coalesce(tag["http"], answer["http"]))
        .withField("cert", F.coalesce(tag["cert"], answer["cert"]))
        .withField("ip_metadata", metadata)
    )


def find_ip_metadata(keys: DataFrame, lookup: DataFrame) -> DataFrame:
    """Metadata of (date, answer ip)."""
    return lookup_join(keys, lookup.select("date", "ip", "metadata"), ["date", "ip"])


def merge_answer_metadata(answer: Column, found: Column) -> Column:
    return answer.withField("ip_metadata", merge_ip_metadata(answer["ip_metadata"], found["metadata"]))


def first_page_fetches(fetches: DataFrame) -> DataFrame:
    """The earliest http and https fetch of each (domain, source, ip), side by side."""
    fetch = F.struct("error", "received")
    order = F.struct("start_time", "end_time", "error", "received.status", "received.headers", "received.tls_cert")
    return fetches.groupBy("domain", "source", "ip").agg(
        F.min_by(fetch, F.when(~F.col("https"), order)).alias("http_fetch"),
        F.min_by(fetch, F.when(F.col("https"), order)).alias("https_fetch"),
    )


def find_page_fetches(keys: DataFrame, fetches: DataFrame) -> DataFrame:
    """Fetched pages of (domain, source, answer ip)."""
    joined = ["domain", "source", "ip"]
    return lookup_join(keys, first_page_fetches(fetches), joined, condition=_if_dated(keys, has_fetches()))


def merge_page_fetches(answer: Column, found: Column) -> Column:
    for name in ("http", "https"):
        fetched = found[f"{name}_fetch"]
        answer = answer.withField(f"{name}_error", F.coalesce(fetched["error"], answer[f"{name}_error"])).withField(
            f"{name}_response", F.coalesce(fetched["received"], answer[f"{name}_response"])
        )
    return answer


def give_back(rows: DataFrame, found: DataFrame, names: list[str], merges: list, staging: str | None = None, key: Column | None = None) -> DataFrame:
    """Merge what was found for sets of answers into the rows that have them; ``key`` is the ``answer_set`` they go by.

    With ``staging`` what was found is a table first, whose size is known before rows are shuffled to meet it.
    """
    some = F.lit(False)
    for name in names:
        some = some | F.col(name).isNotNull()
    by_set = found.filter(some).groupBy(SET_KEY).agg(F.collect_set(F.struct("position", F.struct(*names).alias("found"))).alias("places"))
    by_set = _table(by_set.select(SET_KEY, F.map_from_entries("places").alias("places")), staging)

    joined = lookup_join(rows.withColumn(SET_KEY, answer_set() if key is None else key), by_set, [SET_KEY])
    # Each answer with what was found for it, searched once; every merge sees both as plain values.
    pairs = F.transform("received", lambda answer, place: F.struct(answer.alias("answer"), F.try_element_at("places", place).alias("found")))
    for merge in merges:
        pairs = F.transform(pairs, lambda p: F.struct(merge(p["answer"], p["found"]).alias("answer"), p["found"].alias("found")))  # noqa: B023
    received = F.when(F.col("places").isNull(), F.col("received")).otherwise(F.transform(pairs, lambda p: p["answer"]))
    return joined.withColumn("received", received).select(*rows.columns)


def _table(rows: DataFrame, staging: str | None, compression: str | None = None) -> DataFrame:
    """Rows as a staged table; ``staging`` is None where they are one already."""
    if staging is None:
        return rows
    staged = stage(rows, staging, compression=compression)
    let_go(staged.sparkSession)
    return staged


def _row_table(rows: DataFrame, staging: str | None) -> DataFrame:
    """Wide rows are packed tighter: their ids and texts are most of the disk."""
    return _table(rows, staging, "zstd")


def _found_staging(rows: DataFrame, staging: str | None) -> str | None:
    """Where what was found is staged; its size decides nothing in a session that never broadcasts."""
    broadcasts = not rows.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-")
    return (staging or STAGING) if broadcasts else None


def join_answer_tags(rows: DataFrame, tags: DataFrame, staging: str | None = STAGING) -> DataFrame:
    rows = _row_table(rows, staging)
    by, where = ("source",), has_tags()
    found = find_tags(answer_keys(answer_sets(rows, by, where)), tags)
    return give_back(rows, found, ["tag"], [merge_tags], _found_staging(rows, staging), answer_set(by, where))


def join_answer_ip_metadata(rows: DataFrame, lookup: DataFrame, staging: str | None = STAGING) -> DataFrame:
    rows = _row_table(rows, staging)
    by = ("date",)
    found = find_ip_metadata(answer_keys(answer_sets(rows, by)), lookup)
    return give_back(rows, found, ["metadata"], [merge_answer_metadata], _found_staging(rows, staging), answer_set(by))


def join_page_fetches(rows: DataFrame, fetches: DataFrame, staging: str | None = STAGING) -> DataFrame:
    rows = _row_table(rows, staging)
    by, where = ("domain", "source"), has_fetches()
    found = find_page_fetches(answer_keys(answer_sets(rows, by, where)), fetches)
    return give_back(rows, found, ["http_fetch", "https_fetch"], [merge_page_fetches], _found_staging(rows, staging), answer_set(by, where))


def answer_ip_keys(rows: DataFrame) -> DataFrame:
    """Distinct (date, ip) of all answers."""
    return rows.select("date", F.explode("received.ip").alias("ip")).distinct()


def enrich_answers(
    rows: DataFrame, tags: DataFrame, lookup: DataFrame, fetches: DataFrame, staging: str | None = STAGING, sets: DataFrame | None = None
) -> DataFrame:
    """All three answer joins with one explode of keys and one join back.

    ``sets``: the ``answer_sets`` of the rows as a table; then not the rows are staged, which
    other columns may have been added to, but what is found for the sets.
    """
    kept = None if sets is None else staging
    if sets is None:
        rows = _row_table(rows, staging)
        sets = answer_sets(rows)
    found = find_page_fetches(find_ip_metadata(find_tags(answer_keys(sets), tags), lookup), fetches)
    names = ["tag", "metadata", "http_fetch", "https_fetch"]
    return give_back(rows, found, names, [merge_tags, merge_answer_metadata, merge_page_fetches], kept)
