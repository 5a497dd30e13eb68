"""Outcome rules against pairs of error text and outcome."""

from pyspark.sql import functions as F

from checks.text import PROBE_ERRORS
from scanlake.functions.dns import BAD_DOMAIN_LABEL, classify_dns_error, classify_rcode, is_bad_resolver
from scanlake.functions.outcomes import classify_probe_outcome, mark_outcome

_CASES = "error STRING, scan STRING, status STRING, template BOOLEAN, known BOOLEAN, fp STRING, headers ARRAY<STRING>"


def outcomes(spark, rows):
    frame = spark.createDataFrame(rows, _CASES)
    column = classify_probe_outcome(*[F.col(c) for c in ("error", "scan", "status", "template", "known", "fp", "headers")])
    return [r[0] for r in frame.select(column).collect()]


def test_error_texts(spark):
    rows = [(error, scan, "40", False, None, None, []) for scan, error, _ in PROBE_ERRORS]
    assert outcomes(spark, rows) == [outcome for _, _, outcome in PROBE_ERRORS]


def test_rules_before_the_error(spark):
    rows = [
        (None, "http", None, False, True, "fp", []),
        (None, "http", None, False, True, "", []),
        ("EOF", "http", None, False, False, None, ["A: b", "Server: AkamaiGHost"]),
        (None, "http", None, None, None, None, []),
        ("", "http", None, True, None, None, []),
        ("Status lines does not match", "http", "418 Short and stout", True, None, None, []),
        ("Status lines does not match", "http", "", True, None, None, []),
        ("Certificates do not match;then more", "https", None, True, None, None, []),
    ]
    assert outcomes(spark, rows) == [
        "content/blockpage:fp",
        "content/mismatch",
        "expected/trusted_host:akamai",
        "content/mismatch",
        "expected/match",
        "content/status_mismatch:418",
        "content/status_mismatch",
        "content/tls_mismatch",
    ]


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_marks_and_labels(spark):
    assert one(spark, mark_outcome(F.lit("expected/match"))) == "✅match"
    assert one(spark, mark_outcome(F.lit("read/system"))) == "❔read/system"
    assert one(spark, mark_outcome(F.lit("read/timeout"))) == "❗️read/timeout"
    assert BAD_DOMAIN_LABEL == "❗️️tls.baddomain:"
    assert one(spark, classify_rcode(F.lit(2))) == "❓dns.error:ServFail"
    assert one(spark, classify_rcode(F.lit(24))) == "❗️dns.unknown_rcode:24"
    assert one(spark, classify_dns_error(F.lit('{"Err": {}}'))) == "❓dns.timedout"


def test_missing_rates_are_unknown(spark):
    null = F.lit(None).cast("double")
    assert one(spark, is_bad_resolver(null, F.lit(0.1), F.lit(0.1))) is None
    assert one(spark, is_bad_resolver(null, F.lit(0.8), F.lit(0.1))) is True
    assert one(spark, is_bad_resolver(F.lit(0.75), F.lit(0.1), F.lit(0.1))) is False


def test_first_error_is_cut_out_once(spark):
    from pyspark.sql import functions as F
    from scanlake.functions.outcomes import classify_probe_outcome

    c = F.col
    rows = spark.createDataFrame([("a;b", "http", "200", False, False, "", ["x"])], "e STRING, t STRING, s STRING, m BOOLEAN, k BOOLEAN, p STRING, h ARRAY<STRING>")
    found = rows.select(classify_probe_outcome(c("e"), c("t"), c("s"), c("m"), c("k"), c("p"), c("h")).alias("o"))
    assert found._jdf.queryExecution().analyzed().toString().count("substring_index(") == 1
    assert found.first().o == "unknown/unknown"


def test_stages_of_large_methods_are_compiled(spark):
    from scanlake.session import configure

    assert int(configure(spark).conf.get("spark.sql.codegen.hugeMethodLimit")) <= 8000
