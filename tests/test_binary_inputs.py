"""Binary range files, nested ranges and certificates, written by the tests themselves."""

import random

import pytest

from checks.authored import certificate, certificate_text, networks, range_file
from scanlake.operators.certificates import enrich_certificates
from scanlake.operators.decoded_certificates import decode, decode_certificates
from scanlake.operators.nested_ranges import innermost_ranges
from scanlake.sources.range_files import MalformedFile, TreeFile, ranges_of_file, read_range_file

RANGES = [
    (0x01000000, 0x01FFFFFF, {"autonomous_system_number": 13, "autonomous_system_organization": "One", "country": {"iso_code": "AU", "names": {"en": "x" * 300}}}),
    (0x02000005, 0x02000009, {"organization": "Ünï Org", "autonomous_system_number": 1 << 31}),
    (0x80000000, 0xFFFFFFFE, {"organization": "half", "flags": [True, False, 1 << 40]}),
]


@pytest.mark.parametrize("bits,version", [(24, 4), (28, 6), (32, 6), (28, 4)])
@pytest.mark.parametrize("subtree", [0, 3, 8])
def test_range_file(spark, tmp_path, bits, version, subtree):
    path = tmp_path / "ranges.bin"
    path.write_bytes(range_file(RANGES, bits, version))
    content = spark.read.format("binaryFile").load(str(path)).select("content")
    found = {(r.start_ip, r.end_ip): r for r in ranges_of_file(content, subtree).collect()}
    want = {(first, first + (1 << (32 - length)) - 1): record for start, end, record in RANGES for first, length in networks(start, end)}
    assert found.keys() == want.keys()
    for key, record in want.items():
        row = found[key]
        assert (row.asn, row.as_name, row.org) == tuple(record.get(k) for k in ("autonomous_system_number", "autonomous_system_organization", "organization"))
        assert row.country == record.get("country", {}).get("iso_code")
    assert found[0x01000000, 0x01FFFFFF].netblock == "1.0.0.0/8"


def test_range_file_of_nothing_and_none(spark, tmp_path):
    path = tmp_path / "none.bin"
    path.write_bytes(range_file([]))
    assert read_range_file(spark, str(path)).collect() == []
    assert ranges_of_file(spark.createDataFrame([], "content BINARY")).collect() == []
    for data in (b"", b"no tree", range_file(RANGES)[:50]):
        with pytest.raises(MalformedFile):
            TreeFile(data)


def brute_owner(ranges, number):
    around = [r for r in ranges if r[0] <= number <= r[1]]
    return min(around, key=lambda r: (r[1] - r[0], -r[0]))[2] if around else None


@pytest.mark.parametrize("bits", [16, 12])
def test_nested_ranges(spark, bits):
    rng = random.Random(bits)
    ranges = [(0, 2**32 - 1, "all"), (10 << 24, (11 << 24) - 1, "ten"), (2**32 - 1, 2**32 - 1, "last")]
    for i in range(120):
        start = (10 << 24) + rng.randrange(1 << 22)
        ranges.append((start, start + rng.choice([0, 3, 900, 70_000, 300_000]), f"r{i}"))
    starts = {(a, b): o for a, b, o in ranges}
    ranges = [(a, b, o) for (a, b), o in starts.items()]
    rows = [(a, b, o, len(o)) for a, b, o in ranges] + [(5, 1, "wrong", 0), (None, 7, "none", 0), (10 << 24, (11 << 24) - 1, "older", 1)]
    found = sorted(tuple(r) for r in innermost_ranges(spark.createDataFrame(rows, "start_ip BIGINT, end_ip BIGINT, org STRING, asn INT").where("org <> 'all'"), bits).collect())
    assert all(a[1] < b[0] for a, b in zip(found, found[1:])) and all(a <= b for a, b, *_ in found)
    numbers = {n for a, b, _ in ranges for n in (a - 1, a, b, b + 1, (a + b) // 2)} | {a for a, *_ in found} | {b for _, b, *_ in found}
    inner = [r for r in ranges if r[2] != "all"]
    for number in numbers:
        got = [r for r in found if r[0] <= number <= r[1]]
        assert [r[2] for r in got] == ([brute_owner(inner, number)] if brute_owner(inner, number) else []), number
        assert all(r[3] == len(r[2]) for r in got)


def test_equal_ranges_and_no_ranges(spark):
    schema = "start_ip BIGINT, end_ip BIGINT, org STRING"
    assert innermost_ranges(spark.createDataFrame([], schema)).collect() == []
    same = spark.createDataFrame([(1, 9, "a"), (1, 9, "b"), (1, 9, None)], schema)
    assert [tuple(r) for r in innermost_ranges(same).collect()] == [(1, 9, "b")]
    crossing = spark.createDataFrame([(0, 9, "a"), (5, 14, "b")], schema)
    assert sorted(tuple(r) for r in innermost_ranges(crossing).collect()) == [(0, 4, "a"), (5, 14, "b")]


def test_certificates_of_all_kinds():
    full = decode(certificate_text("www.a.com", "The CA", "210102030405Z", "20500607080910Z", ["a.com", "*.a.com"]))
    assert full == {"common_name": "www.a.com", "issuer": "The CA", "not_before": "2021-01-02T03:04:05", "not_after": "2050-06-07T08:09:10", "sans": ["a.com", "*.a.com"]}
    assert decode(certificate_text(None, "Ünï", "990102030405Z", "490102030405Z"))["not_before"] == "1999-01-02T03:04:05"
    assert decode(certificate_text(None, "Ünï", "990102030405Z", "490102030405Z"))["common_name"] is None
    assert decode(certificate_text("Ünï", "b", "210102030405Z", "210102030405Z", version=1, text=0x1E))["common_name"] == "Ünï"
    text = certificate_text("long" * 100, "b", "210102030405Z", "210102030405Z", ["x" * 200])
    armoured = "-----BEGIN CERTIFICATE-----\n" + "\n".join(text[i : i + 64] for i in range(0, len(text), 64)) + "\n-----END CERTIFICATE-----\n"
    assert decode(armoured) == decode(text)


def test_malformed_certificates_have_no_row(spark):
    good = certificate("a.com", "b", "210102030405Z", "220102030405Z", ["a.com"])
    import base64

    text = lambda data: base64.b64encode(data).decode()
    texts = [text(good[:cut]) for cut in range(0, len(good), 7)] + ["not base64!", "AAAA", text(b"\x30\x80\x00\x00"), text(good + b"\x00")]
    texts += [certificate_text("a", "b", t, "220102030405Z") for t in ("2101020304Z", "219902030405Z", "210102030405")]
    texts += [certificate_text("a", "b", "210102030405Z", "220102030405Z", version=2), certificate_text("a", "b", "210102030405Z", "220102030405Z", version=4)]
    rng = random.Random(1)
    for _ in range(200):  # any damage gives a row or none, never an error
        damaged = bytearray(good)
        damaged[rng.randrange(len(good))] = rng.randrange(256)
        try:
            decode(text(bytes(damaged)))
        except ValueError:
            pass
    rows = spark.createDataFrame([(t,) for t in texts] + [(None,), ("",)], "tls_cert STRING")
    found = decode_certificates(rows).collect()
    assert {r.not_before for r in found} <= {"2021-01-02T03:04:00"} and len(found) <= 1  # seconds may be left out
    both = spark.createDataFrame([(text(good),)] * 3, "tls_cert STRING")
    assert [r.sans for r in decode_certificates(both).collect()] == [["a.com"]]


def test_enriched_from_the_texts(spark):
    from pyspark.sql import functions as F

    from scanlake.functions.records import response

    texts = [certificate_text("a.com", "CA", "210102030405Z", "220102030405Z", ["*.a.com"]), "broken"]
    rows = spark.createDataFrame([(t, "www.a.com") for t in texts], "cert STRING, domain STRING").select("domain", response(tls_cert=F.col("cert")).alias("received"))
    decoded = decode_certificates(rows.select("received.tls_cert"))
    found = {r.received.tls_cert_issuer: r.received for r in enrich_certificates(rows, decoded).collect()}
    assert found["CA"].tls_cert_matches_domain and found["CA"].tls_cert_start_date == "2021-01-02T03:04:05"
    assert found[None].tls_cert_matches_domain is False and found[None].tls_cert_common_name is None
