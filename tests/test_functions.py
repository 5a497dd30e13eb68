import uuid

import pytest
from pyspark.sql import functions as F

from scanlake.constants import MEASUREMENT_NAMESPACE_HEX
from scanlake.functions.certs import cert_matches_domain
from scanlake.functions.ips import invalid_ip_type, ip_to_long, long_to_ip
from scanlake.functions.paths import base_name, between_dates, scan_type_of, source_of
from scanlake.functions.text import (
    domain_from_request,
    http_response_text,
    iso_timestamp,
    measurement_id,
    spaced_json,
    url_host,
)


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_measurement_id_is_a_version_5_uuid(spark):
    name = "a/b.json" + '{"x": "ü"}'
    expected = uuid.uuid5(uuid.UUID(MEASUREMENT_NAMESPACE_HEX), name).hex
    assert one(spark, measurement_id(F.lit("a/b.json"), F.lit('{"x": "ü"}'))) == expected


@pytest.mark.parametrize(
    "sent, domain",
    [
        ("", None),
        ("GET / HTTP/1.1\r\nHost: example5718349450314.com\r\n", "example5718349450314.com"),
        ("GET /path HTTP/1.1\r\nHost: a.com\r\n\r\n", "a.com/path"),
        ("GET news.example.net HTTP/1.1\r\nHost: /page/7\r\n", "news.example.net/page/7"),
        ("GET /a\u0085b\rc HTTP/1.1\r\nHost: d\u2028e.com\r\n", "d\u2028e.com/a\u0085b\rc"),
        ("plain.example.net", "plain.example.net"),
    ],
)
def test_domain_from_request(spark, sent, domain):
    assert one(spark, domain_from_request(F.lit(sent))) == domain


def test_unknown_request_is_an_error(spark):
    with pytest.raises(Exception, match="unknown request format"):
        one(spark, domain_from_request(F.concat(F.lit("what is this "), F.col("id").cast("string"))))


def test_text_helpers(spark):
    stamp = F.lit("2020-02-29 06:45:12.000900700 -0330 NST m=+2.25")
    assert one(spark, iso_timestamp(stamp)) == "2020-02-29T06:45:12.000900700-03:30"
    assert one(spark, url_host(F.lit("203.0.113.9/x/y"))) == "203.0.113.9"
    text = http_response_text(F.lit("200 OK"), F.array(F.lit("A: b"), F.lit("C: d")), F.lit("body"))
    assert one(spark, text) == "200 OK\r\nA: b\r\nC: d\r\n\r\nbody"
    compact = '{"Err":{},"a":"x:y,\\"z","n":[1,2]}'
    assert one(spark, spaced_json(F.lit(compact))) == '{"Err": {}, "a": "x:y,\\"z", "n": [1, 2]}'


def test_paths(spark):
    path = F.lit("s/https/Quack-https-2020-05-11-01-02-08/results.json.gz")
    assert one(spark, base_name(path)) == "results.json"
    assert one(spark, source_of(path)) == "Quack-https-2020-05-11-01-02-08"
    assert one(spark, scan_type_of(source_of(path))) == "https"
    assert one(spark, source_of(F.lit("file"))) == ""
    assert one(spark, between_dates(path, "2020-05-11", "2020-05-11")) is True
    assert one(spark, between_dates(path, "2020-05-12")) is False
    assert one(spark, between_dates(path, None, "2020-05-10")) is False
    with pytest.raises(Exception, match="unknown scan type"):
        one(spark, scan_type_of(F.col("id").cast("string")))


@pytest.mark.parametrize(
    "ip, number",
    [("1.2.3.4", 16909060), ("255.255.255.255", 4294967295), ("256.1.1.1", None), ("::1", None), ("1.2.3", None)],
)
def test_ip_numbers(spark, ip, number):
    assert one(spark, ip_to_long(F.lit(ip))) == number
    if number is not None:
        assert one(spark, long_to_ip(F.lit(number).cast("bigint"))) == ip


def test_private_addresses(spark):
    assert one(spark, invalid_ip_type(F.lit("172.31.255.255"))).endswith("local_net")
    assert one(spark, invalid_ip_type(F.lit("172.32.0.0"))) is None
    assert one(spark, invalid_ip_type(F.lit("172.16.0.x"))) is None


@pytest.mark.parametrize(
    "names, common, domain, matches",
    [
        (["example.com"], None, "EXAMPLE.com", True),
        (["*.example.com"], None, "www.example.com", True),
        (["*.example.com"], None, "a.b.example.com", False),
        (["*.example.com"], None, "example.com", False),
        (["w*.example.com", "www.example.com"], None, "www.example.com", False),
        (["www.example.com", "w*.example.com"], None, "www.example.com", True),
        (["other.com"], "www.example.com", "www.example.com", False),
        ([], "www.example.com", "www.example.com", True),
        ([], None, "www.example.com", False),
        (["*"], None, "localhost", False),
        (["1.2.3.4"], None, "1.2.3.4", False),
    ],
)
def test_cert_matches_domain(spark, names, common, domain, matches):
    array = F.array(*[F.lit(n) for n in names]).cast("array<string>")
    assert one(spark, cert_matches_domain(array, F.lit(common).cast("string"), F.lit(domain))) is matches
