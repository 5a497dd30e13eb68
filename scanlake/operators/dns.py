"""Flatten DNS scan lines of every format version to one row per roundtrip.

Every version is first brought to an array of light roundtrips, which is exploded;
the fields that the roundtrips of a line share are worked out per row afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scanlake.constants import (
    CONTROL_RESOLVERS,
    DNS_CONTROL_V1_FILE,
    DNS_CONTROL_V2_FILE,
    DNS_V2_2_START,
    DNS_V2_START,
)
from scanlake.functions.paths import base_name, path_date, source_of
from scanlake.functions.records import ip_metadata, record, tags_to_flags
from scanlake.functions.text import is_control_domain, iso_timestamp, measurement_id, spaced_json
from scanlake.operators.barrier import explode_once
from scanlake.operators.lines import DeadLetters, parse_json, skip_malformed, tests_before
from scanlake.schemas import (
    ANSWER_FIELDS,
    DNS_CONTROL_ROUNDTRIPS,
    DNS_LINE,
    DNS_ROUNDTRIPS,
    DNS_TAG_MAP,
    struct_ddl,
)

# Format versions.
SINGLE, RETRIES, ROUNDTRIPS, CONTROL = "single", "retries", "roundtrips", "control"

ITEM_FIELDS = [
    ("ip", "STRING"),
    ("http", "STRING"),
    ("cert", "STRING"),
    ("asname", "STRING"),
    ("asnum", "BIGINT"),
    ("tags", "ARRAY<STRING>"),
]
ITEMS = f"ARRAY<{struct_ddl(ITEM_FIELDS)}>"
TRIP_FIELDS = [
    ("url", "STRING"),
    ("error", "STRING"),
    ("rcode", "BIGINT"),
    ("has_type_a", "BOOLEAN"),
    ("start_time", "STRING"),
    ("end_time", "STRING"),
    ("items", ITEMS),
]
TRIPS = f"ARRAY<{struct_ddl(TRIP_FIELDS)}>"


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def _item(ip: Column, **values: Column) -> Column:
    return record(ITEM_FIELDS, ip=ip, **values)


def _trip(**values: Column) -> Column:
    values.setdefault("items", _empty(ITEMS))
    return record(TRIP_FIELDS, **values)


def _tagged_items(entries: Column) -> Column:
    """Items of ``map_entries(ip -> tags)``."""
    return F.transform(entries, lambda e: _item(e["key"], tags=e["value"]))


def _with_single_trips(scans: DataFrame, applies: Column) -> DataFrame:
    """A line of the first version is a single roundtrip; answers are a map or a list."""
    c = F.col
    failed = F.array_contains(F.json_object_keys("value"), "error")
    answers = c("scan.answers")
    items = (
        F.when(answers.startswith("{"), _tagged_items(F.map_entries(parse_json(answers, DNS_TAG_MAP))))
        .when(
            answers.startswith("["),
            F.transform(F.array_distinct(parse_json(answers, "ARRAY<STRING>")), lambda ip: _item(ip)),
        )
        .otherwise(_empty(ITEMS))
    )
    text = c("scan.error")
    trip = _trip(
        url=c("scan.query"),
        error=F.when(text.startswith("{"), spaced_json(text)).otherwise(text),
        rcode=F.when(failed, -1).otherwise(0),
        items=items,
    )
    return scans.withColumn("single", F.when(applies, F.array(trip)))


def _with_retry_trips(scans: DataFrame, applies: Column) -> DataFrame:
    """Roundtrips of a line that lists the code of each try.

    Failed tries come first, each with the next left error when its code is -1;
    then errors that have no code; then the one success, with all answers.
    """
    c = F.col
    tries = F.when(applies, parse_json(c("scan.response"), DNS_TAG_MAP))
    scans = scans.withColumn("tries", tries)
    scans = scans.withColumns(
        {
            "codes": F.coalesce(F.try_element_at("tries", F.lit("rcode")), _empty("ARRAY<STRING>")),
            "errors": F.coalesce(F.try_element_at("tries", F.lit("error")), _empty("ARRAY<STRING>")),
            "addresses": F.filter(F.map_entries("tries"), lambda e: ~e["key"].isin("rcode", "error")),
        }
    )
    succeeded = F.coalesce(F.try_element_at("codes", F.lit(-1)) == "0", F.lit(False))
    scans = scans.withColumn("succeeded", succeeded).withColumn(
        "failed",
        F.transform(
            F.when(c("succeeded"), F.slice("codes", F.lit(1), F.size("codes") - 1)).otherwise(c("codes")),
            lambda code: code.cast("bigint"),
        ),
    )
    timeouts = F.size(F.filter("failed", lambda code: code == -1))

    def failed_trip(code: Column, index: Column) -> Column:
        earlier = F.size(F.filter(F.slice("failed", F.lit(1), index), lambda x: x == -1))
        error = F.when(code == -1, F.get("errors", earlier)).otherwise(c("scan.error"))
        return _trip(rcode=code, error=error)

    left = F.filter("errors", lambda _, index: index >= timeouts)
    left_trips = F.transform(left, lambda error: _trip(rcode=F.lit(-1), error=error))
    success = _trip(rcode=F.lit(0), error=c("scan.error"), items=_tagged_items(c("addresses")))
    several = F.raise_error(
        F.concat(F.lit("DNS measurement with several successful codes: "), c("value"))
    )
    trips = (
        F.when(~applies, F.lit(None).cast(TRIPS))
        .when(F.coalesce(F.size("tries"), F.lit(0)) <= 0, F.array(_trip(error=c("scan.error"))))
        .when(F.exists("failed", lambda code: code == 0), several)
        # Addresses without a successful code: such measurements are dropped.
        .when(~c("succeeded") & (F.size("addresses") > 0), _empty(TRIPS))
        .otherwise(
            F.concat(
                F.transform("failed", failed_trip),
                left_trips,
                F.when(c("succeeded"), F.array(success)).otherwise(_empty(TRIPS)),
            )
        )
    )
    return scans.withColumn("retries", trips)


def _with_listed_trips(scans: DataFrame, roundtrips: Column, control: Column) -> DataFrame:
    """Roundtrips of a line that holds one object per roundtrip, and of control files."""
    c = F.col

    def trip(r: Column) -> Column:
        items = F.transform(
            F.map_entries(r["response"]),
            lambda e: _item(
                e["key"],
                http=e["value"]["http"],
                cert=e["value"]["cert"],
                asname=e["value"]["asname"],
                asnum=e["value"]["asnum"],
                tags=e["value"]["matched"],
            ),
        )
        return _trip(
            url=r["url"],
            error=F.when(~r["error"].isin("", "null"), r["error"]),
            rcode=r["rcode"],
            has_type_a=r["has_type_a"],
            items=F.coalesce(items, _empty(ITEMS)),
        )

    def control_trip(r: Column) -> Column:
        return _trip(
            url=r["url"],
            error=F.when(r["error"] != "null", r["error"]),
            rcode=r["rcode"],
            has_type_a=r["has_type_a"],
            start_time=r["start_time"],
            end_time=r["end_time"],
            items=F.coalesce(F.transform(r["response"], lambda ip: _item(ip)), _empty(ITEMS)),
        )

    response = c("scan.response")
    return scans.withColumn(
        "listed",
        F.when(roundtrips, F.transform(parse_json(response, DNS_ROUNDTRIPS), trip)).when(
            control, F.transform(parse_json(response, DNS_CONTROL_ROUNDTRIPS), control_trip)
        ),
    )


def _answer(item: Column, confidence: Column) -> Column:
    return record(
        ANSWER_FIELDS,
        ip=item["ip"],
        http=item["http"],
        cert=item["cert"],
        matches_control=tags_to_flags(item["tags"]),
        match_confidence=confidence,
        ip_metadata=ip_metadata(as_name=item["asname"], asn=item["asnum"]),
    )


def _flatten(lines: DataFrame, version: Column, counts: Observation | None = None, dead: DeadLetters | None = None) -> DataFrame:
    c = F.col
    v = c("version")
    timed = (F.trim("scan.start_time") != "") & (F.trim("scan.end_time") != "")
    scans = skip_malformed(lines, DNS_LINE, counts, dead).withColumn("version", version)
    scans = _with_single_trips(scans, v == SINGLE)
    # Version 2 results without a start or an end are dropped.
    scans = _with_retry_trips(scans, (v == RETRIES) & timed)
    scans = _with_listed_trips(scans, (v == ROUNDTRIPS) & timed, v == CONTROL)
    trips = F.coalesce("single", "retries", "listed").alias("trips")
    scans = scans.select("file_path", "value", "scan", "version", trips)
    fields = [
        "resolver", "ip", "passed", "error", "vp", "test_url", "location", "passed_control",
        "passed_liveness", "connect_error", "anomaly", "excluded", "exclude_reason", "confidence",
        "start_time", "end_time",
    ]
    tests = F.transform(c("trips"), lambda t: ~is_control_domain(t["url"]))
    kept = [
        measurement_id(c("file_path"), c("value")).alias("measurement_id"),
        source_of(c("file_path")).alias("source"),
        (base_name(c("file_path")) == DNS_CONTROL_V1_FILE).alias("in_control_file"),
        path_date(c("file_path")).cast("string").alias("path_date"),
        F.struct(*[c(f"scan.{f}") for f in fields]).alias("scan"),
        "version",
        tests.alias("tests"),
    ]
    exploded = explode_once(scans, kept, c("trips"), "roundtrip", "t")

    def by_version(**values: Column | None) -> Column:
        chain = F.when(F.lit(False), F.lit(None))
        for name, value in values.items():
            chain = chain.when(v == name, value)
        return chain

    item_count = F.size("t.items")
    # An answer without its confidence is dropped, unless there are none at all.
    rated = F.when(
        (v == ROUNDTRIPS) & c("scan.confidence.matches").isNotNull(),
        F.least(item_count, F.size("scan.confidence.matches")),
    ).otherwise(item_count)
    received = F.transform(
        F.slice("t.items", F.lit(1), rated),
        lambda item, index: _answer(
            item, F.when(v == ROUNDTRIPS, F.get(c("scan.confidence.matches"), index))
        ),
    )
    has_trip_times = v == CONTROL
    start = F.when(has_trip_times, c("t.start_time")).otherwise(c("scan.start_time"))
    end = F.when(has_trip_times, c("t.end_time")).otherwise(c("scan.end_time"))
    is_single = v == SINGLE
    rows = exploded.withColumn("domain", F.coalesce("t.url", "scan.test_url"))
    rows = rows.withColumn("is_control", ~is_single & is_control_domain(c("domain")))
    return rows.select(
        "domain",
        "is_control",
        F.when(is_single, F.coalesce("scan.resolver", "scan.ip")).otherwise(c("scan.vp")).alias("ip"),
        F.when(is_single, c("in_control_file"))
        .when(v == CONTROL, True)
        .otherwise(F.coalesce(c("scan.vp").isin(*CONTROL_RESOLVERS), F.lit(False)))
        .alias("is_control_ip"),
        F.when(is_single, c("path_date")).otherwise(F.substring(start, 1, 10)).alias("date"),
        F.when(~is_single, iso_timestamp(start)).alias("start_time"),
        F.when(~is_single, iso_timestamp(end)).alias("end_time"),
        F.when(is_single, F.lit(0).cast("bigint"))
        .when(v == RETRIES, c("roundtrip").cast("bigint"))
        .when(~c("is_control"), tests_before(c("tests"), c("roundtrip")))
        .alias("retry"),
        F.when(v == ROUNDTRIPS, F.coalesce("t.error", "scan.error")).otherwise(c("t.error")).alias("error"),
        by_version(single=~c("scan.passed"), retries=c("scan.anomaly"), roundtrips=c("scan.anomaly")).alias("anomaly"),
        by_version(
            single=c("t.rcode") == 0,
            retries=~c("scan.connect_error"),
            roundtrips=c("t.rcode") == 0,
            control=~c("scan.connect_error"),
        ).alias("success"),
        by_version(
            single=F.lit(False),
            retries=~c("scan.passed_control"),
            roundtrips=~c("scan.passed_liveness"),
            control=~c("scan.passed_control"),
        ).alias("controls_failed"),
        c("t.rcode").alias("rcode"),
        by_version(
            roundtrips=F.when((c("t.rcode") == 0) & c("t.has_type_a"), True), control=c("t.has_type_a")
        ).cast("boolean").alias("has_type_a"),
        F.when((v == ROUNDTRIPS) & (item_count > 0), c("scan.confidence.average")).alias("average_confidence"),
        F.when(v == ROUNDTRIPS, c("scan.confidence.untagged_controls")).alias("untagged_controls"),
        F.when(v == ROUNDTRIPS, c("scan.confidence.untagged_response")).alias("untagged_response"),
        F.when(v == ROUNDTRIPS, F.coalesce("scan.excluded", F.lit(False))).alias("excluded"),
        F.when(
            v == ROUNDTRIPS, F.coalesce(F.array_join("scan.exclude_reason", " "), F.lit(""))
        ).alias("exclude_reason"),
        received.alias("received"),
        ip_metadata(
            country=F.when(v.isin(RETRIES, ROUNDTRIPS), c("scan.location.country_code"))
        ).alias("ip_metadata"),
        "measurement_id",
        "roundtrip",
        "source",
    )


def flatten_dns_v1(lines: DataFrame) -> DataFrame:
    return _flatten(lines, F.lit(SINGLE))


def flatten_dns_retries(lines: DataFrame) -> DataFrame:
    return _flatten(lines, F.lit(RETRIES))


def flatten_dns_roundtrips(lines: DataFrame) -> DataFrame:
    return _flatten(lines, F.lit(ROUNDTRIPS))


def flatten_dns_control(lines: DataFrame) -> DataFrame:
    return _flatten(lines, F.lit(CONTROL))


def flatten_dns(lines: DataFrame, counts: Observation | None = None, dead: DeadLetters | None = None) -> DataFrame:
    """Rows of observation lines of any version, in one pass.

    The version follows from the path date, the file name and the row date.
    """
    path = F.col("file_path")
    version = (
        F.when(path_date(path) < F.lit(DNS_V2_START).cast("date"), SINGLE)
        .when(base_name(path) == DNS_CONTROL_V2_FILE, CONTROL)
        .when(F.substring("scan.start_time", 1, 10) < DNS_V2_2_START, RETRIES)
        .otherwise(ROUNDTRIPS)
    )
    return _flatten(lines, version, counts, dead)
