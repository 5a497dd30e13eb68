"""Authored lines of every format version."""

import json

import pytest

from scanlake.operators.dns import flatten_dns, flatten_dns_retries
from scanlake.operators.lines import route_by_filename
from scanlake.operators.pages import flatten_page_fetch
from scanlake.operators.probe import flatten_probe

T = "2020-07-04T10:20:30.4-04:00"


def rows(frame):
    return sorted(frame.collect(), key=lambda r: (r.measurement_id, r.roundtrip))


def test_probe_lines_of_both_versions_and_bad_json(make_lines):
    v1 = {
        "Server": "203.0.113.4", "Keyword": "kw.com", "Retries": 1, "Blocked": True, "FailSanity": False, "StatefulBlock": False,
        "Results": [
            {"Sent": "GET / HTTP/1.1\r\nHost: a.com\r\n\r\n", "Success": False, "Error": "e", "StartTime": T, "EndTime": T,
             "Received": '{"status_line": "no object"}'},
            {"Sent": "", "Success": False, "StartTime": T, "EndTime": T},
            {"Sent": "", "Success": True, "StartTime": T, "EndTime": T},
            {"Sent": "rtyutgyhefdafioasfjhjhi.com", "Success": True, "StartTime": T, "EndTime": T,
             "Received": {"status_line": "302", "headers": {"B": ["1", "2"], "A": ["3"]}, "body": "b",
                          "tls": {"version": 771, "cipher_suite": 5, "cert": "C"}}},
        ],
    }
    v2 = {
        "vp": "192.0.2.5", "test_url": "t.com/x", "anomaly": True, "stateful_block": False,
        "response": [
            {"matches_template": True, "control_url": "c.com", "start_time": T, "end_time": T},
            {"matches_template": False, "error": "x", "start_time": T, "end_time": T,
             "response": {"status_line": "403", "body": "", "TlsVersion": 1, "CipherSuite": 2, "Certificate": ["C1", "C2"]}},
            {"matches_template": False, "start_time": T, "end_time": T},
            {"matches_template": True, "control_url": "d.com", "start_time": T, "end_time": T},
        ],
    }
    path = "s/Quack-https-2021-05-30/results.json"
    found = flatten_probe(make_lines((path, json.dumps(v1)), (path, json.dumps(v2)), (path, "{broken"))).collect()
    first = sorted((r for r in found if r.ip == "203.0.113.4"), key=lambda r: r.roundtrip)
    assert [(r.domain, r.retry, r.is_control) for r in first] == [
        ("a.com", 0, False), ("kw.com", 1, False), ("", None, True), ("rtyutgyhefdafioasfjhjhi.com", None, True),
    ]
    assert first[0].received.status == '{"status_line": "no object"}' and first[0].error == "e"
    assert first[1].received.status is None and first[1].received.headers == []
    last = first[3].received
    assert (last.status, last.body, last.headers) == ("302", "b", ["B: 1", "B: 2", "A: 3"])
    assert (last.tls_version, last.tls_cipher_suite, last.tls_cert) == (771, 5, "C")
    second = sorted((r for r in found if r.ip == "192.0.2.5"), key=lambda r: r.roundtrip)
    assert [(r.domain, r.retry) for r in second] == [("c.com", None), ("t.com/x", 0), ("t.com/x", 1), ("d.com", None)]
    assert second[1].received.tls_cert == "C1" and second[0].controls_failed is None
    assert {r.source for r in found} == {"Quack-https-2021-05-30"} and len(found) == 8


def test_line_of_unknown_format_is_an_error(make_lines):
    with pytest.raises(Exception, match="unknown probe format"):
        flatten_probe(make_lines(("s/Quack-http-1/results.json", '{"a": 1}'))).collect()


def dns_v2(**more):
    stamp = "2021-04-25 08:09:10.111222333 -0400 EDT m=+77.7"
    return {
        "vp": "198.51.100.7", "location": {"country_code": "DE"}, "test_url": "t.com", "connect_error": False, "anomaly": True,
        "start_time": stamp, "end_time": stamp, **more,
    }


def test_dns_versions_in_one_pass(make_lines):
    v1 = {"resolver": "r", "query": "q.com", "answers": {"192.0.2.99": ["ip"], "192.0.2.11": []}, "passed": True}
    v1_control = {"ip": "r", "query": "q.com", "answers": ["192.0.2.33"], "error": {"Err": {}, "Net": "udp"}}
    retries = dns_v2(response={"198.51.100.81": ["http"], "rcode": ["2", "-1", "0"], "error": ["e1", "e2"]}, passed_control=True)
    untimed = dns_v2(response={}, passed_control=True, end_time=" ")
    trips = dns_v2(
        passed_liveness=True, excluded=True, exclude_reason=["a", "b"],
        confidence={"average": 50, "matches": [100], "untagged_controls": False, "untagged_response": True},
        response=[
            {"url": "a.root-servers.net", "has_type_a": True, "response": {}, "error": "null", "rcode": 0},
            {"url": "t.com", "has_type_a": True, "error": "null", "rcode": 0, "response": {
                "198.51.100.2": {"http": "h", "cert": "c", "asnum": 5, "asname": "N", "matched": ["ip", "asnum"]},
                "198.51.100.1": {"http": "h", "matched": None}}},
        ],
        start_time="2021-10-20 03:04:05.2 -0400 EDT", end_time="2021-10-20 03:04:05.3 -0400 EDT",
    )
    control = {
        "vp": "192.0.2.8", "test_url": "t.com", "passed_control": True, "connect_error": False,
        "response": [{"url": "t.com", "has_type_a": True, "response": ["192.0.2.77"], "error": "null", "rcode": 0,
                      "start_time": "2021-04-25 09:08:07.2 -0400 EDT m=+1", "end_time": "2021-04-25 09:08:07.3 -0400 EDT m=+1"}],
    }
    found = flatten_dns(
        make_lines(
            ("d/Satellite-2018-08-03/interference.json", json.dumps(v1)),
            ("d/Satellite-2018-08-03/answers_control.json.gz", json.dumps(v1_control)),
            ("d/Satellite-2021-04-25/results.json", json.dumps(retries)),
            ("d/Satellite-2021-04-25/results.json", json.dumps(untimed)),
            ("d/Satellite-2021-10-20/results.json", json.dumps(trips)),
            ("d/Satellite-2021-04-25/responses_control.json", json.dumps(control)),
        )
    ).collect()
    by_source = lambda s, ip: sorted((r for r in found if r.source.endswith(s) and r.ip == ip), key=lambda r: r.roundtrip)
    old = {r.is_control_ip: r for r in by_source("2018-08-03", "r")}
    assert [a.ip for a in old[False].received] == ["192.0.2.99", "192.0.2.11"]
    assert old[False].received[0].matches_control.ip and old[False].received[1].matches_control is None
    assert (old[True].error, old[True].rcode, old[True].success) == ('{"Err": {}, "Net": "udp"}', -1, False)
    tries = by_source("2021-04-25", "198.51.100.7")
    assert [(r.retry, r.rcode, r.error, len(r.received)) for r in tries] == [
        (0, 2, None, 0), (1, -1, "e1", 0), (2, -1, "e2", 0), (3, 0, None, 1),
    ]
    assert tries[0].start_time == "2021-04-25T08:09:10.111222333-04:00" and tries[0].ip_metadata.country == "DE"
    both = by_source("2021-10-20", "198.51.100.7")
    assert [(r.domain, r.is_control, r.retry, r.average_confidence) for r in both] == [
        ("a.root-servers.net", True, None, None), ("t.com", False, 0, 50.0),
    ]
    # The second answer has no confidence and is dropped.
    assert [a.ip for a in both[1].received] == ["198.51.100.2"] and both[1].received[0].match_confidence == 100.0
    assert both[1].received[0].ip_metadata.as_name == "N" and both[1].exclude_reason == "a b" and both[1].has_type_a
    trusted = by_source("2021-04-25", "192.0.2.8")[0]
    assert trusted.is_control_ip and trusted.anomaly is None and trusted.received[0].ip == "192.0.2.77"


def test_several_successes_are_an_error(make_lines):
    line = json.dumps(dns_v2(response={"rcode": ["0", "1", "0"]}, passed_control=True))
    with pytest.raises(Exception, match="several successful codes"):
        flatten_dns_retries(make_lines(("d/Satellite-2021-04-25/results.json", line))).collect()


def test_page_fetch_gives_two_rows(make_lines):
    line = {
        "ip": "192.0.2.99", "keyword": "x.com", "fetched": True, "trusted_cert": True,
        "start_time": "2021-09-16 11:12:13.141516171 -0400 EDT m=+9", "end_time": "2021-09-16 11:12:14.1 -0400 EDT m=+1",
        "http": 'Get "http": {odd', "https": {"status_line": "200", "headers": {"S": ["x"]}, "body": "dropped", "TlsVersion": 771,
                                            "CipherSuite": 1, "Certificate": "C"},
    }
    http, https = sorted(
        flatten_page_fetch(make_lines(("d/Satellite-2021-09-16/blockpages.json", json.dumps(line)))).collect(), key=lambda r: r.https
    )
    assert http.error == 'Get "http": {odd' and http.received.status is None
    assert https.error is None and https.received.status == "200" and https.received.body is None
    assert https.received.tls_cert == "C" and https.received.tls_cert_has_trusted_ca and http.date == "2021-09-16"


def test_unknown_file_is_an_error(make_lines):
    with pytest.raises(Exception, match="unknown DNS file name"):
        route_by_filename(make_lines(("d/Satellite-1/odd.json", "{}")))["observations"].collect()
