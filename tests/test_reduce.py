import datetime

from pyspark.sql import functions as F

from scanlake.operators.analysis import all_under_threshold, success_interference_ratios
from scanlake.operators.categories import first_wins_by_priority, lookup_with_fallback
from scanlake.operators.reduce import keep_last_retry, last_retry, reduce_scans
from scanlake.operators.signatures import Signature, match_signatures
from scanlake.operators.suffixes import registered_domain


def test_last_retries_and_unnumbered_rows(spark):
    rows = spark.createDataFrame(
        [("d", "m", 0), ("d", "m", 1), ("d", "m", 1), ("d", "m", None), ("e", "m", 0), ("d", "n", None), ("d", "n", None)],
        "date STRING, measurement_id STRING, retry BIGINT",
    )
    kept = sorted(map(str, keep_last_retry(rows, last_retry(rows)).collect()))
    want = [("d", "m", 1), ("d", "m", 1), ("d", "m", None), ("e", "m", 0), ("d", "n", None), ("d", "n", None)]
    assert kept == sorted(f"Row(date='{d}', measurement_id='{m}', retry={r})" for d, m, r in want)


def test_reduction_drops_unknown_and_failed_outcomes(spark):
    rows = spark.createDataFrame(
        [(o, asn, org, control) for o, asn, org, control in [
            ("✅match", 5, "Org", True), ("✅match", 5, "Org", True), ("❔setup/system_failure", 5, None, False),
            ("❔read/system", 5, None, False), (None, 5, None, False), ("❔setup.system_failure", None, "Org", None),
        ]],
        "outcome STRING, server_asn BIGINT, server_organization STRING, domain_is_control BOOLEAN",
    )
    full = rows.select(
        "*", F.lit(datetime.date(2022, 1, 1)).alias("date"), F.lit("DNS").alias("source"), F.lit("US").alias("server_country"),
        F.lit("Net").alias("server_as_full_name"), F.lit(None).cast("string").alias("server_name"), F.lit("d.com").alias("domain"),
        F.lit(None).cast("string").alias("domain_category"),
    )
    found = sorted((r.outcome, r.subnetwork, r.domain, r["count"]) for r in reduce_scans(full).fillna("-", ["subnetwork"]).collect())
    assert found == [("✅match", "AS5 - Org", "CONTROL", 2), ("❔setup.system_failure", "-", "d.com", 1)]


def test_registered_domains(spark):
    hosts = {
        "dns.a.com.": "a.com", "x.y.co.uk": "y.co.uk", "co.uk": None, "special": "special", "a.b.c.ck": "b.c.ck",
        "q.www.ck": "www.ck", "host.unlisted": "host.unlisted", "com": None, "B.Example.COM": "Example.COM",
    }
    rows = spark.createDataFrame([(h,) for h in [*hosts, None]], "host STRING")
    rules = spark.createDataFrame([(r,) for r in ("com", "uk", "co.uk", "*.ck", "!www.ck")], "rule STRING")
    found = {r.host: r.name for r in registered_domain(rows, rules, "host", "name").collect()}
    assert found == hosts | {None: None}


def test_signatures_in_order_with_false_positives_first(spark):
    harmless = [Signature("fine", "fp1")]
    blocked = [Signature("a.*b", "first"), Signature("a", "second")] + [Signature(f"none{i}", f"n{i}") for i in range(120)] + [Signature("z$", "last")]
    pages = {"a fine b": (False, "fp1"), "a\nb": (True, "first"), "ac": (True, "second"), "xyz": (True, "last"), "": (None, None), None: (None, None)}
    rows = spark.createDataFrame([(p, True) for p in pages] + [("a", False), ("a", None)], "page STRING, anomaly BOOLEAN")
    found = rows.select("page", "anomaly", match_signatures(F.col("page"), F.col("anomaly"), harmless, blocked).alias("m")).collect()
    assert {r.page: (r.m.is_known_blockpage, r.m.page_signature) for r in found if r.anomaly} == pages
    assert all(tuple(r.m) == (None, None) for r in found if not r.anomaly)


def test_ranked_lists_and_fallbacks(spark):
    lists = spark.createDataFrame(
        [(0, 0, "https://www.a.com/x", "global"), (1, 0, "http://a.com/", "local"), (1, 1, "ftp://b.com", "no"), (1, 2, "http://c.d.com", "sub")],
        "rank INT, line BIGINT, url STRING, category STRING",
    )
    merged = first_wins_by_priority(lists)
    assert {r.domain: r.category for r in merged.collect()} == {"www.a.com": "global", "a.com": "global", "c.d.com": "sub"}
    asked = spark.createDataFrame([("a.com", "old"), ("www.c.d.com", "old"), ("d.com", ""), ("www9.a.com", "")], "domain STRING, old_category STRING")
    found = {r.domain: r.category for r in lookup_with_fallback(asked, merged).collect()}
    assert found == {"a.com": "global", "www.c.d.com": "old", "d.com": "None", "www9.a.com": "global"}


def test_ratios_fill_missing_sides_and_missing_days_fail(spark):
    rows = spark.createDataFrame(
        [("1", "a", "S", "success", 3), ("1", "a", "S", "interference", 1), ("1", "b", "S", "success", 2), ("2", "a", "S", "success", 1), ("1", "c", "S", "unknown", 9)],
        "date STRING, domain STRING, source STRING, result_type STRING, count BIGINT",
    )
    found = {r.domain: (r.success_count, r.interference_count, r.success_ratio) for r in success_interference_ratios(rows).collect()}
    assert found == {"a": (4, 1, 0.8), "b": (2, 0, 1.0)}
    daily = success_interference_ratios(rows, ("date", "domain", "source"))
    assert [r.domain for r in all_under_threshold(daily, 0.3).collect()] == ["a"]
