"""Raw files to tables, exports and the dashboard."""

import gzip
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from scanlake.constants import OBSERVATION_FILES
from scanlake.operators.signatures import Signature
from scanlake.plans.dashboard import build_dashboard
from scanlake.plans.dns_table import build_dns_table
from scanlake.plans.load import load_scan
from scanlake.plans.probe_table import ReferenceData, build_probe_table
from scanlake.schemas import DNS_TABLE, PROBE_TABLE
from scanlake.sources.files import (
    exported_sources,
    list_files,
    read_lines,
    require_reconciled,
    select_input_files,
)
from scanlake.sources.reference_data import (
    parse_two_section_file,
    read_as_types,
    read_categories,
    read_country_names,
    read_org_ranges,
    read_prefix_table,
    read_ranked_lists,
    read_signatures,
)
from scanlake.sources.sinks import (
    EmptyResult,
    clear_staged,
    csv_export,
    fail_if_empty,
    publish_table,
    write_base_table,
    write_json_export,
)
from scanlake.streaming.incremental import closed_sources, load_new_files, stream_files


def put(folder, name, *lines):
    path = os.path.join(str(folder), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    text = "".join(line if isinstance(line, str) else json.dumps(line) + "\n" for line in lines)
    opener = gzip.open if name.endswith(".gz") else open
    with opener(path, "wt", encoding="utf-8") as out:
        out.write(text)
    return path


@pytest.fixture(scope="module")
def store(tmp_path_factory):
    return tmp_path_factory.mktemp("store")


@pytest.fixture(scope="module")
def data(spark, store):
    routes = put(store, "ref/routeviews-rv2-20220601-1200.pfx2as.gz", "8.8.8.0\t24\t15169\n", "5.0.0.0\t8\t77_78\n", "9.0.0.0\t8\t79\n")
    orgs = put(
        store, "ref/org2info.txt", "# format:org_id|changed|org_name|country|source\n", "G-ORG|20120130|Google LLC|US|ARIN\n",
        "# format:aut|changed|aut_name|org_id|opaque_id|source\n", "15169|20120224|GOOGLE|G-ORG|x|ARIN\n", "79|2012|NINE|MISSING|x|RIPE\n",
    )
    types = put(store, "ref/types.txt", "# comment\n", "15169|some_class|Content\n")
    categories = put(store, "ref/categories.csv", "t.com,News Media\n", "d.com,Gaming\n")
    names = put(store, "ref/names.csv", '"United States",US\n', '"Korea, Republic of",KR\n')
    ranges = put(store, "ref/ranges.csv", "134744064,134744100,Suborg,15169\n")
    blocked = put(store, "ref/blocked.json", {"pattern": "blocked <b>", "fingerprint": "fp_b"}, "\n", {"pattern": "old", "fingerprint": "fp_c"},
                  {"pattern": "new", "fingerprint": "fp_c"})
    listed = read_signatures(spark, blocked)
    assert listed == [Signature("blocked <b>", "fp_b"), Signature("new", "fp_c")]
    certificates = spark.range(1).select(
        F.sha2(F.lit("CERT"), 256).alias("cert_sha"), F.lit("cn").alias("common_name"), F.lit("CA").alias("issuer"),
        F.lit("2021-01-01").cast("timestamp").alias("not_before"), F.lit("2031-01-01").cast("timestamp").alias("not_after"),
        F.array(F.lit("d.com")).alias("sans"),
    )
    return ReferenceData(
        routes=read_prefix_table(spark, routes),
        as_org=parse_two_section_file(spark.read.text(orgs)),
        as_type=read_as_types(spark, types),
        categories=read_categories(spark, categories),
        certificates=certificates,
        country_names=read_country_names(spark, names),
        org_ranges=read_org_ranges(spark, ranges),
        blockpages=listed,
    )


def probe_line(vp, error=None, page=None, anomaly=True):
    trip = {"matches_template": not anomaly, "start_time": "2022-06-02T01:01:09.61-04:00", "end_time": "2022-06-02T01:01:10-04:00"}
    if error:
        trip["error"] = error
    if page:
        trip["response"] = {"status_line": "200 OK", "headers": {"Server": ["x"]}, "body": page, "TlsVersion": 771, "CipherSuite": 1, "Certificate": "CERT"}
    return {"vp": vp, "test_url": "t.com/path", "anomaly": anomaly, "controls_failed": False, "stateful_block": False, "response": [trip]}


@pytest.fixture(scope="module")
def probe(spark, store, data):
    put(
        store, "https/Quack-https-2022-06-02-01/results.json.gz", probe_line("8.8.8.8", error="read: i/o timeout"),
        probe_line("5.1.1.1", page="a blocked <b> page"), probe_line("77.0.0.1", anomaly=False), "broken\n",
    )
    put(store, "https/Quack-https-2022-06-02-01/other.json", {"x": 1})
    put(store, "https/Quack-https-2022-06-03-01/results.json", "")
    files = list_files(spark, f"{store}/https")
    chosen = select_input_files(files, "https", start="2022-06-01")
    paths = [r.path for r in chosen.collect()]
    assert [p.split("/")[-1] for p in paths] == ["results.json.gz"]
    return build_probe_table(read_lines(spark, paths), data, staging="probe")


def test_probe_table(spark, probe):
    assert probe.schema.simpleString() == spark.createDataFrame([], PROBE_TABLE).schema.simpleString()
    rows = {r.server_ip: r for r in probe.collect()}
    timeout, page, calm = rows["8.8.8.8"], rows["5.1.1.1"], rows["77.0.0.1"]
    assert (timeout.outcome, timeout.server_asn, timeout.server_as_full_name, timeout.server_organization) == ("read/timeout", 15169, "Google LLC", "Suborg")
    assert (timeout.domain_category, timeout.server_country, timeout.server_as_class) == ("News Media", "US", "Content")
    assert (page.outcome, page.page_signature, page.server_asn) == ("content/blockpage:fp_b", "fp_b", 77)
    assert page.received_tls_cert_common_name == "cn" and page.received_tls_cert_matches_domain is False
    assert (calm.outcome, calm.server_asn, calm.received_headers) == ("expected/match", None, [])
    assert str(timeout.start_time) == "2022-06-02 05:01:09.610000" and str(timeout.date) == "2022-06-02"


def dns_line(vp, domain, ip):
    stamp = "2022-06-02 14:51:41.2 -0400 EDT"
    return {
        "vp": vp, "test_url": domain, "location": {"country_code": "DE"}, "anomaly": True, "connect_error": False, "passed_liveness": True,
        "start_time": stamp, "end_time": stamp, "confidence": {"average": 1, "matches": None, "untagged_controls": False, "untagged_response": False},
        "response": [{"url": domain, "has_type_a": True, "error": "null", "rcode": 0,
                      "response": {ip: {"http": "h", "cert": "c", "asnum": 5, "asname": "GOOGLE CLOUD", "matched": ["http"]}}}],
    }


@pytest.fixture(scope="module")
def dns(spark, store, data):
    folder = "satellite/Satellite-2022-06-02-12-00-01"
    put(store, f"{folder}/results.json", dns_line("9.9.9.9", "d.com", "8.8.8.8"), dns_line("1.1.1.1", "d.com", "8.8.8.8"), dns_line("9.9.9.9", "t.com", "10.0.0.1"))
    put(store, f"{folder}/resolvers.json", {"vp": "9.9.9.9", "name": "dns.nine.net.", "location": {"country_code": "FR"}})
    put(store, f"{folder}/resolvers_profile.json", {"resolver": "9.9.9.9", "non_zero_rcode": "0.1", "connect_error": "0.2", "invalid_cert": "0.3"})
    put(store, f"{folder}/tagged_responses.json", {"ip": "8.8.8.8", "http": "x", "cert": None, "asname": "x", "asnum": 1})
    page = {"status_line": "200", "headers": {"S": ["new"]}, "body": "gone", "TlsVersion": 771, "CipherSuite": 1, "Certificate": "CERT"}
    fetch = {"keyword": "d.com", "ip": "8.8.8.8", "fetched": True, "trusted_cert": True, "start_time": "2022-06-02 1:1:1 -0400", "end_time": "2022-06-02 1:1:2 -0400"}
    put(store, f"{folder}/blockpages.json", fetch | {"http": "failed", "https": page})
    paths = [r.path for r in select_input_files(list_files(spark, f"{store}/satellite"), "satellite").collect()]
    assert len(paths) == 5
    return build_dns_table(read_lines(spark, paths), data, staging="dns")


def test_dns_table(spark, dns):
    assert dns.schema.simpleString() == spark.createDataFrame([], DNS_TABLE).schema.simpleString()
    rows = {(r.resolver_ip, r.domain): r for r in dns.collect()}
    assert len(rows) == 3
    row = rows["9.9.9.9", "d.com"]
    assert (row.resolver_name, row.resolver_country, row.resolver_asn, row.resolver_as_name) == ("dns.nine.net.", "FR", 79, "NINE")
    assert (row.resolver_non_zero_rcode_rate, row.domain_category, row.resolver_is_trusted) == (0.1, "Gaming", False)
    answer = row.answers[0]
    assert (answer.asn, answer.as_name, answer.ip_organization, answer.censys_http_body_hash) == (15169, "GOOGLE", "Suborg", "h")
    assert (answer.http_error, answer.https_response_status, answer.https_response_body) == ("failed", "200", None)
    assert answer.https_tls_cert_matches_domain and answer.https_tls_cert_has_trusted_ca and answer.https_tls_cert_issuer == "CA"
    assert (answer.https_analysis_is_known_blockpage, answer.https_analysis_page_signature) == (True, "fp_c")
    assert (answer.match_confidence, row.average_confidence, row.exclude_reason, row.untagged_controls) == (25.0, 25.0, "is_CDN", False)
    trusted = rows["1.1.1.1", "d.com"]
    assert trusted.resolver_is_trusted and trusted.excluded is False and trusted.answers[0].match_confidence is None


def test_dns_rows_do_not_move_to_small_lookups(dns):
    """Lookups are tables of what is in use, so their size is known before the rows could be shuffled for them."""
    plan = dns._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan and plan.count("BroadcastHashJoin") >= 4


def test_dashboard(spark, dns, probe, data):
    codes = data.country_names
    rules = spark.createDataFrame([("net",)], "rule STRING")
    whole = build_dashboard({"https": probe, "satellite": dns}, codes, rules, "2022-01-01")
    found = sorted((r.source, r.country_name, r.domain, r.outcome, r.reg_hostname, r["count"], r.unexpected_count) for r in whole.collect())
    # Only the good resolver and the domain with a valid certificate remain of the DNS rows.
    assert found == [
        ("DNS", "FR", "d.com", "✅tls.validcert", "nine.net", 1, 0),
        ("HTTPS", "United States", "t.com/path", "❗️read/timeout", None, 1, 1),
    ]
    assert build_dashboard({"https": probe, "satellite": dns}, codes, rules, "2022-06-03").count() == 0
    publish_table(whole, "reduced_scans", "v1")
    assert spark.table("reduced_scans").count() == 2 and spark.table("reduced_scans_v1").count() == 2


def test_dashboard_reads_answers_once(spark, dns, data, tmp_path):
    """Outcomes, tries and capable domains come from one pass over the table."""
    dns.write.parquet(str(tmp_path / "base"))
    rules = spark.createDataFrame([("net",)], "rule STRING")
    whole = build_dashboard({"satellite": spark.read.parquet(str(tmp_path / "base"))}, data.country_names, rules, "2022-01-01", "judged")
    assert not any("/base/" in f for f in whole.inputFiles()) and any("/judged/" in f for f in whole.inputFiles())
    assert [(r.domain, r.outcome, r["count"]) for r in whole.collect()] == [("d.com", "✅tls.validcert", 1)]
    assert clear_staged(spark, "judged")


def test_load_scan(spark, store, data, tmp_path):
    table, out = str(tmp_path / "probe"), str(tmp_path / "out")
    put(
        store, "load/Quack-https-2022-06-02-01/results.json.gz", probe_line("8.8.8.8", error="read: i/o timeout"),
        probe_line("77.0.0.1", anomaly=False), "broken\n",
    )
    assert load_scan(spark, f"{store}/load", "https", data, table, out) == (1, 3, 1, 2, 1)
    assert load_scan(spark, f"{store}/load", "https", data, table, out) == (0, 0, 0, 0, 0)
    put(store, "load/Quack-https-2022-06-05-01/results.json", probe_line("5.1.1.1"))
    assert load_scan(spark, f"{store}/load", "https", data, table, out) == (1, 1, 0, 1, 1)
    assert spark.read.parquet(table).count() == 3
    assert {r.source for r in exported_sources(list_files(spark, out)).collect()} == {"Quack-https-2022-06-02-01", "Quack-https-2022-06-05-01"}
    put(store, "load/Quack-https-2022-06-06-01/results.json", "broken, and long enough to be read as a file\n")
    with pytest.raises(EmptyResult):
        load_scan(spark, f"{store}/load", "https", data, table, out)
    report = load_scan(spark, f"{store}/satellite", "satellite", data, str(tmp_path / "dns"))
    assert report == (5, 3, 0, 3, 2)


def test_repeated_exports_replace_their_folders(spark, probe, tmp_path):
    out = str(tmp_path / "export")
    for _ in range(2):
        write_json_export(probe, out)
    assert spark.read.option("recursiveFileLookup", "true").text(out).count() == probe.count()


def test_last_line_of_a_key_wins(spark, store):
    types = put(store, "twice/types.txt", "7|x|Old\n", "8|x|Other\n", "7|x|New\n")
    assert {(r.asn, r.as_class) for r in read_as_types(spark, types).collect()} == {(7, "New"), (8, "Other")}
    categories = put(store, "twice/categories.csv", "a.com,One\n", "a.com,Two\n")
    assert [tuple(r) for r in read_categories(spark, categories).collect()] == [("a.com", "Two")]
    names = put(store, "twice/names.csv", "Old Land,OL\n", "New Land,OL\n")
    assert [tuple(r) for r in read_country_names(spark, names).collect()] == [("New Land", "OL")]
    lines = spark.createDataFrame(
        [(1, "O|1|First|AA|s"), (2, "5|1|OLD|O|x|s"), (3, "O|2|Second|BB|s"), (4, "5|2|NEW|O|x|s")], "line INT, value STRING"
    ).repartition(3)
    assert [tuple(r) for r in parse_two_section_file(lines).collect()] == [(5, "NEW", "Second", "BB")]


def test_tables_and_exports(spark, probe, dns, tmp_path):
    path = str(tmp_path / "table")
    assert fail_if_empty(probe, path) == 3
    write_base_table(probe, path, append=True)
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(EmptyResult):
        fail_if_empty(probe.filter("domain = 'none'"), str(tmp_path / "empty"))
    out = str(tmp_path / "export")
    write_json_export(probe, out)
    assert {r.source for r in exported_sources(list_files(spark, out)).collect()} == {"Quack-https-2022-06-02-01"}
    folder = os.path.join(out, "source=Quack-https-2022-06-02-01")
    assert sorted(os.listdir(folder)) == ["country=None", "country=US"]
    record = json.loads(gzip.open([os.path.join(folder, "country=US", f) for f in os.listdir(os.path.join(folder, "country=US")) if f.endswith(".gz")][0]).readline())
    assert record["server_country"] == "US" and record["source"] and "outcome" not in record and "page_signature" in str(probe.columns)
    write_json_export(dns, str(tmp_path / "dns"))
    require_reconciled(probe, exported_sources(list_files(spark, out)))
    with pytest.raises(ValueError, match="1 sources missing in export"):
        require_reconciled(probe, exported_sources(list_files(spark, str(tmp_path / "dns"))))
    csv_export(probe.select("domain", "outcome"), str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == ["domain", "outcome"]


def test_sources_are_renewed_as_their_files_arrive(spark, tmp_path):
    put(tmp_path, "in/Satellite-2022-06-02/results.json", {"a": 1}, {"a": 2})
    put(tmp_path, "in/Satellite-2022-06-02/notes.json", {"a": 3})
    out, checkpoint, built = str(tmp_path / "out"), str(tmp_path / "checkpoint"), []

    def build(lines):
        """Every row knows how many lines its source has, as rows know the tags of their source."""
        built.append(1)
        whole = lines.select(F.count("*").alias("lines"))
        return lines.crossJoin(F.broadcast(whole)).select(F.lit("2022-06-02").cast("date").alias("date"), "value", "lines")

    def run(target=out, mark=checkpoint):
        load_new_files(spark, str(tmp_path / "in"), OBSERVATION_FILES, build, target, mark).awaitTermination()
        return sorted((r.value, r.lines) for r in spark.read.parquet(target).collect())

    assert run() == [('{"a": 1}', 2), ('{"a": 2}', 2)]
    put(tmp_path, "in/Satellite-2022-06-03/results.json.gz", {"a": 4})
    assert run() == [('{"a": 1}', 2), ('{"a": 2}', 2), ('{"a": 4}', 1)]
    assert run() == [('{"a": 1}', 2), ('{"a": 2}', 2), ('{"a": 4}', 1)] and len(built) == 2
    # The rest of the first source arrives in a later run: the table is that of one run.
    put(tmp_path, "in/Satellite-2022-06-02/interference.json", {"a": 5})
    later = run()
    assert later == [('{"a": 1}', 3), ('{"a": 2}', 3), ('{"a": 4}', 1), ('{"a": 5}', 3)] and len(built) == 3
    assert run(str(tmp_path / "once"), str(tmp_path / "once-checkpoint")) == later


def test_a_source_waits_for_all_its_kinds_of_file(spark, tmp_path):
    kinds = {"answers": ["results.json", "responses.json"], "tags": ["tags.json"], "pages": ["pages.json"]}
    names = [n for group in kinds.values() for n in group]
    out, built = str(tmp_path / "out"), []

    def build(lines):
        built.append(sorted(r.value for r in lines.collect()))
        return lines.select(F.lit("2022-06-02").cast("date").alias("date"), "value")

    def run(wait_ms=None):
        load_new_files(spark, str(tmp_path / "in"), names, build, out, str(tmp_path / "mark"), kinds, wait_ms).awaitTermination()

    put(tmp_path, "in/Satellite-1/results.json", {"a": 1})
    put(tmp_path, "in/Satellite-2/tags.json", {"b": 1})
    run()
    put(tmp_path, "in/Satellite-1/tags.json.gz", {"a": 2})
    run()
    assert built == []
    put(tmp_path, "in/Satellite-1/pages.json", {"a": 3})
    put(tmp_path, "in/Satellite-1/readme.json", {"a": 0})
    run()
    assert built == [['{"a": 1}', '{"a": 2}', '{"a": 3}']]  # parts in three runs: one build
    put(tmp_path, "in/Satellite-1/responses.json", {"a": 4})  # late, but not lost
    run()
    assert built[1:] == [['{"a": 1}', '{"a": 2}', '{"a": 3}', '{"a": 4}']]
    assert spark.read.parquet(out).count() == 4


def test_a_waiting_source_is_closed_by_its_timer(spark, tmp_path):
    kinds = {"answers": ["results.json"], "tags": ["tags.json"]}
    put(tmp_path, "in/Satellite-1/results.json", {"a": 1})
    files = stream_files(spark, str(tmp_path / "in"), ["results.json", "tags.json"])
    query = closed_sources(files, kinds, wait_ms=1).writeStream.format("memory").queryName("closed_by_timer").outputMode("append").start()
    try:
        deadline = time.time() + 90
        while not spark.sql("SELECT * FROM closed_by_timer").count() and time.time() < deadline:
            time.sleep(0.5)
        assert [tuple(r) for r in spark.sql("SELECT * FROM closed_by_timer").collect()] == [("Satellite-1", False)]
    finally:
        query.stop()


def test_ranked_lists_are_numbered(spark, tmp_path):
    paths = [put(tmp_path, "global.csv", "http://a.com,X,One\n", "http://b.com,X,Two\n"), put(tmp_path, "ad.csv", "http://a.com,X,Three\n")]
    rows = [(r["rank"], r.line, r.category) for r in read_ranked_lists(spark, paths).collect()]
    assert rows == [(0, 0, "One"), (0, 1, "Two"), (1, 0, "Three")]


def test_address_lookup_is_a_table_before_probe_rows_meet_it(spark, make_lines, data):
    line = json.dumps(probe_line("5.1.1.1", page="a blocked <b> page"))
    table = build_probe_table(make_lines(("https/Quack-https-2022-06-02-01/results.json", line)), data, staging="narrow")
    (row,) = table.collect()
    assert (row.server_asn, row.received_tls_cert_issuer, row.received_tls_cert_matches_domain, row.domain_category) == (77, "CA", False, "News Media")
    assert (row.outcome, row.received_headers) == ("content/blockpage:fp_b", ["Server: x"])
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan  # the ranges of the lookup are joined already
