"""Answer enrichment, confidence and exclusion on small rows."""

import functools

from pyspark.sql import functions as F

from scanlake.functions.dns import all_true, any_true
from scanlake.functions.records import ip_metadata, record, response
from scanlake.operators import answers
from scanlake.operators.answers import (
    STAGING,
    answer_keys,
    answer_sets,
    enrich_answers,
    explode_answers,
    join_answer_tags,
    join_page_fetches,
    join_resolver_facts,
    join_resolver_tags,
    regroup_answers,
)
from scanlake.operators.postprocess import postprocess
from scanlake.schemas import ANSWER, ANSWER_FIELDS, MATCHES_CONTROL_FIELDS
from scanlake.sources.sinks import clear_staged


def answer(ip, flags=None, http=None, cert=None, as_name=None, asn=None):
    matches = None
    if flags is not None:
        matches = record(MATCHES_CONTROL_FIELDS, **{f: F.lit(True) for f in flags})
    values = {"http": http, "cert": cert}
    literals = {k: F.lit(v) for k, v in values.items() if v is not None}
    if matches is not None:
        literals["matches_control"] = matches
    metadata = ip_metadata(
        **{k: F.lit(v) for k, v in {"as_name": as_name, "asn": asn}.items() if v is not None}
    )
    return record(ANSWER_FIELDS, ip=F.lit(ip), ip_metadata=metadata, **literals)


def dns_row(spark, mid, answers, **fields):
    values = {
        "measurement_id": mid, "roundtrip": 0, "source": "s", "domain": "d.com", "date": "2021-04-25", "ip": "1.2.3.4",
        "is_control": False, "is_control_ip": False, "anomaly": True, "average_confidence": None,
        "untagged_controls": None, "untagged_response": None, "excluded": None, "exclude_reason": None, **fields,
    }
    kinds = {"average_confidence": "double", "exclude_reason": "string", "roundtrip": "int", "ip": "string", "domain": "string",
             "measurement_id": "string", "source": "string", "date": "string"}
    return spark.range(1).select(
        *[F.lit(v).cast(kinds.get(k, "boolean")).alias(k) for k, v in values.items()],
        F.array(*answers).cast(f"ARRAY<{ANSWER}>").alias("received"),
        ip_metadata(country=F.lit("own")).alias("ip_metadata"),
    )


def test_regroup_keeps_order_copies_and_empty_rows(spark):
    ips = [f"9.0.0.{i}" for i in (3, 1, 2, 1)]
    filled = dns_row(spark, "a", [answer(ip) for ip in ips])
    rows = filled.union(filled).union(filled).union(dns_row(spark, "b", [])).union(dns_row(spark, "b", []))
    back = regroup_answers(explode_answers(rows)).select(*rows.columns)
    got = sorted((r.measurement_id, [a.ip for a in r.received]) for r in back.collect())
    assert got == [("a", ips)] * 3 + [("b", [])] * 2


def test_enrichment_explodes_and_regroups_once(spark):
    rows = dns_row(spark, "a", [answer("9.0.0.1"), answer("9.0.0.2", as_name="old")])
    tags = spark.createDataFrame(
        [("s", "9.0.0.1", "h", None, "N", 5), ("s", "9.0.0.2", None, "c", None, None), ("other", "9.0.0.2", "x", "x", "x", 9)],
        "source STRING, ip STRING, http STRING, cert STRING, as_name STRING, asn BIGINT",
    )
    lookup = spark.range(1).select(
        F.lit("2021-04-25").alias("date"), F.lit("9.0.0.2").alias("ip"), ip_metadata(asn=F.lit(7), netblock=F.lit("9.0.0.0/8")).alias("metadata")
    )
    fetches = spark.range(1).select(
        F.lit("d.com").alias("domain"), F.lit("s").alias("source"), F.lit("9.0.0.1").alias("ip"), F.lit("t").alias("start_time"),
        F.lit("t").alias("end_time"), F.lit(True).alias("https"), F.lit(None).cast("string").alias("error"),
        response(status=F.lit("200")).alias("received"),
    )
    enriched = enrich_answers(rows, tags, lookup, fetches)
    first, second = enriched.first().received
    assert (first.http, first.ip_metadata.as_name, first.ip_metadata.asn, first.https_response.status) == ("h", "N", 5, "200")
    assert (second.cert, second.ip_metadata.as_name, second.ip_metadata.asn, second.https_response) == ("c", "old", 7, None)
    plan = enriched._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("posexplode") == 1 and plan.count("collect_set") == 1


def test_wide_rows_move_once(spark):
    rows = dns_row(spark, "a", [answer("9.0.0.1")]).withColumn("wide", F.lit("w"))
    tags = spark.createDataFrame([("s", "9.0.0.1", "h", None, "N", 5)], "source STRING, ip STRING, http STRING, cert STRING, as_name STRING, asn BIGINT")
    kept = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for k in kept:
            spark.conf.set(k, "-1")
        plan = join_answer_tags(rows, tags)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in kept:
            spark.conf.unset(k)
    assert "BroadcastHashJoin" not in plan
    # The wide column passes one exchange: the narrow branch does not have it.
    wide = [line for line in plan.splitlines() if "wide" in line]
    assert len(wide) <= 4 and plan.count("Exchange hashpartitioning") >= 3


def test_rows_are_read_once_and_answers_searched_once(spark, tmp_path):
    """Rows that are no table are staged: the join reads that table and never works them out again."""
    source = tmp_path / "source"
    dns_row(spark, "a", [answer("9.0.0.1")]).write.parquet(str(source))
    rows = spark.read.parquet(str(source)).withColumn("source", F.concat("source", F.lit("")))
    tags = spark.createDataFrame([("s", "9.0.0.1", "h", None, "N", 5)], "source STRING, ip STRING, http STRING, cert STRING, as_name STRING, asn BIGINT")
    joined = join_answer_tags(rows, tags)
    assert not any("/source/" in f for f in joined.inputFiles())
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_element_at") + plan.count("element_at(places") == 1
    assert joined.first().received[0].http == "h"
    assert clear_staged(spark, STAGING)


def test_rows_with_equal_answers_are_looked_up_once(spark):
    ips = [answer("9.0.0.1"), answer("9.0.0.2")]
    rows = dns_row(spark, "a", ips).union(dns_row(spark, "b", ips)).union(dns_row(spark, "c", ips[::-1]))
    rows = rows.union(dns_row(spark, "d", ips, domain=None)).union(dns_row(spark, "e", []))
    sets = answer_sets(rows)
    assert sets.count() == 3 and answer_keys(sets).count() == 6
    tags = spark.createDataFrame([("s", "9.0.0.1", "h", None, "N", 5)], "source STRING, ip STRING, http STRING, cert STRING, as_name STRING, asn BIGINT")
    found = {r.measurement_id: [a.http for a in r.received] for r in join_answer_tags(rows, tags).collect()}
    assert found == {"a": ["h", None], "b": ["h", None], "c": [None, "h"], "d": ["h", None], "e": []}


def test_resolver_facts_need_an_address_only(spark):
    rows = dns_row(spark, "a", []).union(dns_row(spark, "b", [], date=None)).union(dns_row(spark, "c", [], ip=None))
    rows = rows.union(dns_row(spark, "d", [], ip="4.3.2.1"))
    names = ["name", "country", "non_zero_rcode_rate", "private_ip_rate", "zero_ip_rate", "connect_error_rate", "invalid_cert_rate"]
    tags = spark.range(1).select(F.lit("s").alias("source"), F.lit("1.2.3.4").alias("ip"), *[F.lit("n" if n == "name" else None).cast("string" if n in names[:2] else "double").alias(n) for n in names])
    lookup = spark.range(1).select(F.lit("2021-04-25").alias("date"), F.lit("1.2.3.4").alias("ip"), ip_metadata(asn=F.lit(7)).alias("metadata"))
    joined = join_resolver_facts(rows, rows, tags, lookup, "facts")
    found = {r.measurement_id: (r.ip_metadata.name, r.ip_metadata.asn, r.ip_metadata.country) for r in joined.collect()}
    assert found == {"a": ("n", 7, "own"), "b": ("n", None, "own"), "c": (None, None, "own"), "d": (None, None, "own")}


def test_tags_are_for_the_older_format(spark):
    tags = spark.createDataFrame([("s", "9.0.0.1", "h", None, "N", 5)], "source STRING, ip STRING, http STRING, cert STRING, as_name STRING, asn BIGINT")
    newer = dns_row(spark, "a", [answer("9.0.0.1")], date="2021-06-24")
    assert join_answer_tags(newer, tags).first().received[0].http is None
    assert join_answer_tags(dns_row(spark, "a", [answer("9.0.0.1")]), tags).first().received[0].http == "h"


def test_first_fetch_wins_and_old_rows_get_none(spark):
    schema = "start_time STRING, https BOOLEAN, error STRING, status STRING"
    fetches = spark.createDataFrame([("2", False, None, "late"), ("1", False, None, "early"), ("1", True, "broken", None)], schema).select(
        F.lit("d.com").alias("domain"), F.lit("s").alias("source"), F.lit("9.0.0.1").alias("ip"), "start_time",
        F.col("start_time").alias("end_time"), "https", "error", response(status=F.col("status")).alias("received"),
    )
    found = join_page_fetches(dns_row(spark, "a", [answer("9.0.0.1")]), fetches).first().received[0]
    assert found.http_response.status == "early" and found.https_error == "broken"
    old = join_page_fetches(dns_row(spark, "a", [answer("9.0.0.1")], date="2021-02-28"), fetches).first().received[0]
    assert old.http_response is None


def test_resolver_tags(spark):
    tags = spark.createDataFrame(
        [("s", "1.2.3.4", "name", None, None), ("s", "1.2.3.4", None, "US", 0.5), ("t", "1.2.3.4", "no", "no", 1.0)],
        "source STRING, ip STRING, name STRING, country STRING, non_zero_rcode_rate DOUBLE",
    )
    for rate in ("private_ip_rate", "zero_ip_rate", "connect_error_rate", "invalid_cert_rate"):
        tags = tags.withColumn(rate, F.lit(None).cast("double"))
    metadata = join_resolver_tags(dns_row(spark, "a", []), tags).first().ip_metadata
    assert (metadata.name, metadata.country, metadata.non_zero_rcode_rate) == ("name", "US", 0.5)


def test_confidence_and_exclusion(spark):
    tagged = {"http": "h", "cert": "c", "as_name": "AMAZON-1", "asn": 1}
    mixed = [
        answer("1.1.1.1", [], **tagged), answer("1.1.1.2", ["http", "cert"], **tagged),
        answer("1.1.1.3", ["http", "cert", "asnum", "asname"], http="h", cert="c", as_name="OTHER AMAZON", asn=2),
        answer("1.1.1.4", ["ip"]),
    ]
    rows = (
        dns_row(spark, "mixed", mixed)
        .union(dns_row(spark, "untagged", [answer("1.1.1.1")], domain="e.com"))
        .union(dns_row(spark, "calm", [answer("1.1.1.1", **tagged)], anomaly=False))
        .union(dns_row(spark, "control", [answer("1.1.1.1", http="h"), answer("2.2.2.2", **tagged)], is_control_ip=True, excluded=True))
        .union(dns_row(spark, "domain", [answer("1.1.1.1")], is_control=True))
    )
    found = {r.measurement_id: r for r in postprocess(rows).collect()}
    mixed_row = found["mixed"]
    assert [a.match_confidence for a in mixed_row.received] == [0, 50, 100, 100]
    assert mixed_row.average_confidence == 62.5 and not mixed_row.untagged_controls and not mixed_row.untagged_response
    assert (mixed_row.anomaly, mixed_row.excluded, mixed_row.exclude_reason) == (True, True, "is_CDN is_CDN")
    untagged = found["untagged"]
    assert (untagged.average_confidence, untagged.untagged_controls, untagged.untagged_response, untagged.anomaly) == (0, True, True, False)
    assert untagged.excluded is None and found["calm"].exclude_reason is None
    assert found["control"].excluded is True and found["control"].average_confidence is None
    assert found["domain"].untagged_response is None


def test_logical_aggregates_ignore_nulls(spark):
    def both(*values):
        array = F.array(*[F.lit(v).cast("boolean") for v in values]).cast("array<boolean>")
        return spark.range(1).select(any_true(array, lambda v: v), all_true(array, lambda v: v)).first()[0:2]

    assert both(True, None) == (True, True)
    assert both(False, None, True) == (True, False)
    assert both(None) == (None, None)
    assert both() == (None, None)


def asked_sets(monkeypatch):
    """Number of sets of answers that each enrichment looks up."""
    counts, give_back = [], answers.give_back

    def seen(rows, found, *args, **more):
        counts.append(found.select("answer_set").distinct().count())
        return give_back(rows, found, *args, **more)

    monkeypatch.setattr(answers, "give_back", seen)
    return counts


def dated_rows(spark, dates, domains=("d.com",), sources=("s",)):
    rows = [
        dns_row(spark, f"{source}{domain}{date}", [answer("9.0.0.1"), answer("9.0.0.2", as_name="old")], date=date, domain=domain, source=source)
        for date in dates for domain in domains for source in sources
    ]
    return functools.reduce(lambda a, b: a.union(b), [*rows, dns_row(spark, "none", [], date=dates[0])])


def test_metadata_is_looked_up_by_date_and_addresses(spark, monkeypatch):
    counts = asked_sets(monkeypatch)
    rows = dated_rows(spark, ["2021-04-25", "2021-04-26", None], domains=("d.com", None), sources=("s", "t"))
    lookup = spark.range(1).select(
        F.lit("2021-04-25").alias("date"), F.lit("9.0.0.2").alias("ip"), ip_metadata(asn=F.lit(7)).alias("metadata")
    )
    joined = answers.join_answer_ip_metadata(rows, lookup)
    got = sorted((str(r.date), *[(a.ip_metadata.asn, a.ip_metadata.as_name) for a in r.received]) for r in joined.collect())
    plain, found = ((None, None), (None, "old")), ((None, None), (7, "old"))
    assert got == sorted([("2021-04-25",)] + [("2021-04-25", *found)] * 4 + [(d, *plain) for d in ("2021-04-26", "None")] * 4)
    assert counts == [3]  # one a date
    # What was found is a table before rows are shuffled to meet it, and its key is short.
    assert "collect_set" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert answer_sets(rows).select(F.max(F.length("answer_set"))).first()[0] == 16


def test_page_fetches_are_looked_up_once_for_all_dates(spark, monkeypatch):
    counts = asked_sets(monkeypatch)
    rows = dated_rows(spark, ["2021-02-27", "2021-02-28", "2021-03-01", "2021-04-02", "2021-05-03", None], domains=("d.com", "e.com"))
    fetches = spark.range(1).select(
        F.lit("d.com").alias("domain"), F.lit("s").alias("source"), F.lit("9.0.0.2").alias("ip"), F.lit("t").alias("start_time"),
        F.lit("t").alias("end_time"), F.lit(True).alias("https"), F.lit("late").alias("error"), response(status=F.lit("200")).alias("received"),
    )
    got = {r.measurement_id: [(a.https_error, a.http_error) for a in r.received] for r in join_page_fetches(rows, fetches).collect()}
    fetched = {m for m, found in got.items() if ("late", None) in found}
    assert len(got) == 13 and fetched == {f"sd.com{d}" for d in ("2021-03-01", "2021-04-02", "2021-05-03")}
    assert all(found == [(None, None), ("late", None)] for m, found in got.items() if m in fetched)
    assert counts == [2]  # one a domain


def test_answer_tags_are_looked_up_once_for_all_dates_and_domains(spark, monkeypatch):
    counts = asked_sets(monkeypatch)
    rows = dated_rows(spark, ["2021-06-23", "2021-06-22", "2021-06-24", "2021-07-01", None], domains=("d.com", "e.com"))
    tags = spark.createDataFrame([("s", "9.0.0.2", "h", None, "N", 5)], "source STRING, ip STRING, http STRING, cert STRING, as_name STRING, asn BIGINT")
    joined = {r.measurement_id: [(a.http, a.ip_metadata.as_name, a.ip_metadata.asn) for a in r.received] for r in join_answer_tags(rows, tags).collect()}
    tagged = {m for m, found in joined.items() if found and found[1][0] == "h"}
    assert len(joined) == 11 and tagged == {f"s{n}{d}" for n in ("d.com", "e.com") for d in ("2021-06-22", "2021-06-23")}
    assert all(found == [(None, None, None), ("h", "N", 5)] for m, found in joined.items() if m in tagged)
    assert counts == [1]
