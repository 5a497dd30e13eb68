"""Outcome rules, labels, categories, signatures and certificates."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import functions as F

from checks.authored import certificate_text
from checks.common import query, relation, shown, shown_sql, table, texts_sql
from scanlake.functions.certs import cert_matches_domain
from scanlake.functions.dns import classify_dns_error, classify_rcode
from scanlake.functions.labels import mask_control_domain, subnetwork_label
from scanlake.functions.outcomes import classify_probe_outcome, mark_outcome, unexpected_count
from scanlake.functions.records import merge_non_null
from scanlake.operators.categories import (
    categorize_domain,
    first_wins_by_priority,
    lookup_with_fallback,
)
from scanlake.operators.certificates import cert_key, enrich_certificates
from scanlake.operators.decoded_certificates import decode_certificates
from scanlake.operators.joins import lookup_join
from scanlake.operators.signatures import Signature, match_signatures
from scanlake.operators.suffixes import registered_domain

# Own sentences around the phrases that decide, each with the outcome expected of it.
PROBE_ERRORS = [
    ("echo", "opening port 40001 on host twelve: address already in use", "setup/system_failure"),
    ("discard", "step two ended with protocol error", "setup/system_failure"),
    ("echo", "on this kernel: protocol not available", "setup/system_failure"),
    ("https", "worker 9 stopped, too many open files", "setup/system_failure"),
    ("http", "from the lab the network is unreachable", "dial/ip.network_unreachable"),
    ("http", "hop three says no route to host", "dial/ip.host_no_route"),
    ("discard", "port 9 answered: connection refused", "dial/tcp.refused"),
    ("echo", "after 30 s, context deadline exceeded", "dial/timeout"),
    ("echo", "attempt 4, connect: connection timed out", "dial/timeout"),
    ("discard", "connection reset by peer before any byte", "dial/tcp.reset"),
    ("discard", "attempt 5, connect: connection reset by peer", "dial/tcp.reset"),
    ("http", "attempt 6, getsockopt: connection reset by peer", "dial/tcp.reset"),
    ("https", "layer tls: odd record at byte 7", "tls/tls.failed"),
    ("https", "alert 20 as remote error: checksum", "tls/tls.failed"),
    ("https", "alert 10 as local error: order", "tls/tls.failed"),
    ("https", "transport gave readLoopPeekFailLocked: <nil>", "tls/tls.failed"),
    ("https", "hello seen but no mutual cipher suite", "tls/tls.failed"),
    ("https", "flight two is missing ServerKeyExchange message", "tls/tls.failed"),
    ("https", "gave up, TLS handshake timeout on try 2", "tls/timeout"),
    ("echo", "sending line 1, write: connection reset by peer", "write/tcp.reset"),
    ("echo", "sending line 2, write: broken pipe", "write/system"),
    ("http", "the timer fired and request canceled by it", "read/timeout"),
    ("echo", "waiting for line 3, i/o timeout;second part is not read", "read/timeout"),
    ("discard", "while closing, shutdown: transport endpoint is not connected", "read/system"),
    ("http", "waiting for page 8, read: connection reset by peer (try 1)", "read/tcp.reset"),
    ("http", "page 9 cut, unexpected EOF", "read/http.truncated_response"),
    ("https", "page 10 blank, EOF", "read/http.empty"),
    ("echo", "line 4 blank, EOF", "content/mismatch"),
    ("http", "late: http: server closed idle connection", "read/http.truncated_response"),
    ("http", "page 11 has a trailer header without chunked transfer encoding", "http/http.invalid"),
    ("http", "moved, yet response missing Location header", "http/http.invalid"),
    ("http", "page 12 has a bad Content-Length of minus one", "http/http.invalid"),
    ("http", "page 13: failed to parse Location header (blank)", "http/http.invalid"),
    ("http", "page 14 is malformed HTTP from byte 0", "http/http.invalid"),
    ("http", "page 15 is malformed MIME from line 2", "http/http.invalid"),
    # These texts are compared as a whole.
    ("echo", "Incorrect echo response", "content/mismatch"),
    ("discard", "Received response", "content/mismatch"),
    ("http", "Incorrect web response: status lines don't match", "content/status_mismatch:40"),
    ("http", "Incorrect web response: bodies don't match", "content/body_mismatch"),
    ("https", "Incorrect web response: certificates don't match", "content/tls_mismatch"),
    ("https", "Incorrect web response: cipher suites don't match", "content/tls_mismatch"),
    ("https", "Incorrect web response: TLS versions don't match", "content/tls_mismatch"),
    ("echo", "echo response does not match echo request", "content/mismatch"),
    ("discard", "discard response is not empty", "content/mismatch"),
    ("http", "Status lines does not match", "content/status_mismatch:40"),
    ("http", "Bodies do not match;and a second part", "content/body_mismatch"),
    ("https", "Certificates do not match;and a second part", "content/tls_mismatch"),
    ("https", "Cipher suites do not match", "content/tls_mismatch"),
    ("https", "TLS versions do not match", "content/tls_mismatch"),
    ("https", "Status lines do not match", "content/status_mismatch:40"),
    ("http", "line 5: header field missing", "content/header_mismatch"),
    ("http", "line 6: header field mismatch", "content/header_mismatch"),
    ("http", "nothing known about this one", "unknown/unknown"),
    ("echo", "line 7 cut, unexpected EOF", "content/mismatch"),
]


def pick_sql(values: list[str], index: str) -> str:
    return f"list_extract([{texts_sql(values)}], CAST({index} % {len(values)} + 1 AS INTEGER))"


def pick(values: list[str], index):
    return F.get(F.array(*[F.lit(v) for v in values]), (index % len(values)).cast("int"))


_SCAN, _ERROR, _OUTCOME = ([e[i] for e in PROBE_ERRORS] for i in range(3))


@query(
    "classify_probe_outcome",
    f"""SELECT event_id, CASE
      WHEN event_type = 'signup' AND user_id % 4 = 0 THEN 'content/blockpage:fp' || user_id
      WHEN event_type = 'view' AND user_id % 5 = 0 THEN 'expected/trusted_host:akamai'
      WHEN event_type = 'click' THEN CASE WHEN user_id % 3 = 0 THEN 'expected/match' ELSE 'content/mismatch' END
      ELSE replace({pick_sql(_OUTCOME, "event_id")}, ':40', CASE WHEN user_id % 2 = 0 THEN ':40' || (user_id % 10) ELSE '' END)
      END AS outcome FROM events""",
)
def probe_outcome(spark, sf):
    c = F.col
    kind, user = c("event_type"), c("user_id")
    return table(spark, sf, "events").select(
        "event_id",
        classify_probe_outcome(
            error=F.when(kind == "click", F.when(user % 2 == 0, "")).otherwise(pick(_ERROR, c("event_id"))),
            scan_type=pick(_SCAN, c("event_id")),
            status=F.when(user % 2 == 0, F.concat(F.lit("40"), (user % 10).cast("string"), F.lit(" No"))).otherwise(""),
            matches_template=F.when(user % 3 == 0, True).when(user % 3 == 1, False),
            is_known_blockpage=F.when(user % 4 == 0, kind == "signup"),
            page_signature=F.concat(F.lit("fp"), user.cast("string")),
            headers=F.when(
                (kind == "view") & (user % 5 == 0), F.array(F.lit("A: b"), F.lit("Server: GHost"))
            ).otherwise(F.array(F.lit("Server: nginx"))),
        ).alias("outcome"),
    )


_MARKS = [
    ("setup/system_failure", "❔setup/system_failure"), ("unknown/unknown", "❔unknown/unknown"),
    ("dial/timeout", "❔dial/timeout"), ("read/system", "❔read/system"),
    ("expected/match", "✅match"), ("expected/trusted_host:akamai", "✅trusted_host:akamai"),
    ("content/blockpage:x", "❗️content/blockpage:x"), ("read/timeout", "❗️read/timeout"),
    ("write/tcp.reset", "❗️write/tcp.reset"), ("tls/tls.failed", "❓tls/tls.failed"),
    ("content/mismatch", "❓content/mismatch"), ("http/http.invalid", "❓http/http.invalid"),
]


@query(
    "mark_outcome",
    f"SELECT event_id, {pick_sql([m for _, m in _MARKS], 'event_id')} || event_type AS marked FROM events",
)
def marks(spark, sf):
    outcome = F.concat(pick([o for o, _ in _MARKS], F.col("event_id")), F.col("event_type"))
    return table(spark, sf, "events").select("event_id", mark_outcome(outcome).alias("marked"))


@query(
    "unexpected_count",
    f"""SELECT event_id, {shown_sql(unexpected_count='''CASE event_id % 13 WHEN 4 THEN 0 WHEN 5 THEN 0
      WHEN 6 THEN user_id WHEN 7 THEN user_id WHEN 8 THEN user_id WHEN 9 THEN user_id
      WHEN 10 THEN user_id WHEN 11 THEN user_id END''')} FROM events""",
)
def unexpected(spark, sf):
    outcome = pick([m for _, m in _MARKS] + ["❓read/udp.timeout"], F.col("event_id"))
    counted = unexpected_count(outcome, F.col("user_id"))
    return table(spark, sf, "events").select("event_id", *shown(unexpected_count=counted))


_RCODES = (
    "FormErr ServFail NXDomain NotImp Refused YXDomain YXRRSet NXRRSet NotAuth NotZone DSOTYPENI "
    "Unassigned Unassigned Unassigned Unassigned BadVers BadSig BadKey BadTime BadMode BadAlg "
    "BadTrunc BadCookie"
).split()


@query(
    "classify_rcode",
    f"""SELECT event_id, CASE WHEN r BETWEEN 1 AND 23
        THEN CASE WHEN r = 2 THEN '❓' ELSE '❗️' END || 'dns.error:' || list_extract([{texts_sql(_RCODES)}], CAST(r AS INTEGER))
        ELSE '❗️dns.unknown_rcode:' || r END AS outcome
        FROM (SELECT event_id, event_id % 30 - 2 AS r FROM events)""",
)
def rcodes(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", classify_rcode(F.col("event_id") % 30 - 2).alias("outcome")
    )


_DNS_ERRORS = [
    ('{"Err": {}, "Op": "read"}', "❓dns.timedout"), ('{"Op": "r", "Err": 90}', "❗️dns.msgsize"),
    ('{"Err": 111}', "❗️dns.connrefused"), ('{"Err": 113}', "❔dns.hostunreach"),
    ('{"Err": 24}', "❔setup.system_failure"), ("{}", "❗️dns.unknown"),
    ("no_answer", "❗️dns.no_answer"), ("read udp 1.2.3.4: i/o timeout", "❓dns.timedout"),
    ("write: message too long", "❗️dns.msgsize"), ("read: connection refused", "❗️dns.connrefused"),
    ("read: no route to host", "❔dns.hostunreach"), ("dns: short read", "❗️dns.msgsize"),
    ("udp read: protocol error", "❗️dns.protocol_error"),
    ("dial: socket: too many open files", "❔setup.system_failure"),
    ("odd", "❗️unknown_error:odd"),
]


@query(
    "classify_dns_error",
    f"SELECT event_id, {pick_sql([o for _, o in _DNS_ERRORS], 'event_id').replace('{', '{{').replace('}', '}}')} AS outcome FROM events".replace("{{", "{").replace("}}", "}"),
)
def dns_errors(spark, sf):
    error = pick([e for e, _ in _DNS_ERRORS], F.col("event_id"))
    return table(spark, sf, "events").select("event_id", classify_dns_error(error).alias("outcome"))


@query(
    "mask_control_domain",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN 'CONTROL' ELSE 'd' || user_id END AS domain FROM events""",
)
def masked(spark, sf):
    domain = F.concat(F.lit("d"), F.col("user_id").cast("string"))
    control = F.when(F.col("event_type") == "click", True).when(F.col("event_type") == "view", False)
    return table(spark, sf, "events").select("event_id", mask_control_domain(domain, control).alias("domain"))


@query(
    "subnetwork_label",
    """SELECT s_suppkey, """
    + shown_sql(label="""CASE WHEN s_suppkey % 7 > 0 THEN 'AS' || s_suppkey || CASE WHEN s_nationkey % 2 = 0 THEN ' - ' || s_name ELSE '' END END""")
    + " FROM supplier",
)
def subnetworks(spark, sf):
    c = F.col
    label = subnetwork_label(F.when(c("s_suppkey") % 7 > 0, c("s_suppkey")), F.when(c("s_nationkey") % 2 == 0, c("s_name")))
    return table(spark, sf, "supplier").select("s_suppkey", *shown(label=label))


@query(
    "merge_non_null",
    "SELECT c_custkey, "
    + shown_sql(
        a="CASE WHEN c_custkey % 2 = 0 THEN c_name WHEN c_custkey % 3 = 0 THEN c_mktsegment END",
        b="CASE WHEN c_nationkey % 2 = 0 THEN c_nationkey ELSE c_custkey END",
    )
    + " FROM customer",
)
def merged(spark, sf):
    c = F.col
    base = F.struct(F.when(c("c_custkey") % 3 == 0, c("c_mktsegment")).alias("a"), c("c_custkey").alias("b"))
    new = F.struct(
        F.when(c("c_custkey") % 2 == 0, c("c_name")).alias("a"),
        F.when(c("c_nationkey") % 2 == 0, c("c_nationkey").cast("bigint")).alias("b"),
    )
    rows = table(spark, sf, "customer").select("c_custkey", base.alias("base"), new.alias("new"))
    one = rows.withColumn("m", merge_non_null(c("base"), c("new"), ["a", "b"]))
    return one.select("c_custkey", *shown(a=c("m.a"), b=c("m.b")))


# Pages with their host, and a rule-made list of hosts with a category.
HOSTS = "SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM {pages}"


@query(
    "categorize_domain",
    f"""WITH p AS ({HOSTS}), k AS (SELECT host, min(page_id) AS first FROM p WHERE host NOT LIKE 'm.%' GROUP BY host)
    SELECT page_id, """
    + shown_sql(category="CASE WHEN page_id % 5 = 0 THEN 'Control' ELSE 'C' || first % 9 END")
    + " FROM p LEFT JOIN k USING (host)",
)
def categorized(spark, sf):
    pages = relation(spark, sf, HOSTS)
    listed = (
        pages.filter(~F.col("host").startswith("m."))
        .groupBy(F.col("host").alias("domain"))
        .agg(F.concat(F.lit("C"), (F.min("page_id") % 9).cast("string")).alias("category"))
    )
    rows = pages.select(
        "page_id",
        F.regexp_replace("url", "^https?://", "").alias("domain"),
        (F.col("page_id") % 5 == 0).alias("is_control"),
    )
    return categorize_domain(rows, listed).select("page_id", *shown("category"))


_LISTS = "SELECT page_id % 4 AS rank, page_id AS line, url, 'C' || page_id % 9 AS category FROM {pages}"
_RANKED_SQL = f"""l AS ({_LISTS}),
  h AS (SELECT *, regexp_extract(url, '^https?://([^/]*)', 1) AS host FROM l),
  named AS (SELECT rank, line, 0 AS kind, host AS domain, category FROM h
    UNION ALL SELECT rank, line, 1, regexp_extract(host, '([^.]+\\.[^.]+)$', 1), category FROM h WHERE host LIKE 'www%'),
  ranked AS (SELECT domain, category FROM (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY rank, line, kind) AS rn FROM named) WHERE rn = 1)"""


@query("first_wins_by_priority", f"WITH {_RANKED_SQL} SELECT domain, category FROM ranked")
def first_wins(spark, sf):
    return first_wins_by_priority(relation(spark, sf, _LISTS)).select("domain", "category")


@query(
    "lookup_with_fallback",
    f"""WITH {_RANKED_SQL},
    d AS (SELECT DISTINCT CASE line % 3 WHEN 0 THEN host WHEN 1 THEN replace(host, 'www.', '') ELSE 'www.' || host END AS domain,
      CASE WHEN host LIKE 'blog%' THEN 'old' ELSE '' END AS old_category FROM h)
    SELECT d.domain, coalesce(e.category, a.category, nullif(old_category, ''), 'None') AS category
    FROM d LEFT JOIN ranked e ON e.domain = d.domain
    LEFT JOIN ranked a ON a.domain = CASE WHEN d.domain LIKE 'www%' THEN regexp_extract(d.domain, '([^.]+\\.[^.]+)$', 1) ELSE 'www.' || d.domain END""",
)
def fallback(spark, sf):
    c = F.col
    pages = relation(spark, sf, HOSTS)
    name = (
        F.when(c("page_id") % 3 == 0, c("host"))
        .when(c("page_id") % 3 == 1, F.regexp_replace("host", r"www\.", ""))
        .otherwise(F.concat(F.lit("www."), c("host")))
    )
    domains = pages.select(
        name.alias("domain"), F.when(c("host").startswith("blog"), "old").otherwise("").alias("old_category")
    ).distinct()
    return lookup_with_fallback(domains, first_wins_by_priority(relation(spark, sf, _LISTS)))


SUFFIX_RULES = ["com", "net", "org", "uk", "co.uk", "*.ck", "!www.ck", "example.org"]


def suffix_rules(spark):
    listed = F.array(*[F.lit(rule) for rule in SUFFIX_RULES])
    return spark.range(1).select(F.explode(listed).alias("rule"))


@query(
    "registered_domain",
    f"""WITH p AS ({HOSTS}) SELECT page_id, """
    + shown_sql(
        name="""CASE page_id % 7
          WHEN 0 THEN CASE WHEN host LIKE '%.example.org' THEN regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1)
                           ELSE regexp_extract(host, '([^.]+\\.[^.]+)$', 1) END
          WHEN 1 THEN regexp_extract(host, '([^.]+)$', 1) || '.co.uk'
          WHEN 2 THEN 'special' WHEN 3 THEN 'www.ck'
          WHEN 4 THEN regexp_extract(host, '([^.]+)$', 1) || '.zone.ck'
          WHEN 6 THEN regexp_extract(host, '([^.]+)$', 1) || '.unlisted' END"""
    )
    + " FROM p",
)
def registered(spark, sf):
    c = F.col
    kind = c("page_id") % 7
    host = (
        F.when(kind == 0, c("host"))
        .when(kind == 1, F.concat(c("host"), F.lit(".co.uk.")))
        .when(kind == 2, "special")
        .when(kind == 3, F.concat(c("host"), F.lit(".www.ck")))
        .when(kind == 4, F.concat(c("host"), F.lit(".zone.ck")))
        .when(kind == 5, "co.uk")
        .otherwise(F.concat(c("host"), F.lit(".unlisted")))
    )
    rows = relation(spark, sf, HOSTS).select("page_id", host.alias("hostname"))
    rules = suffix_rules(spark)
    return registered_domain(rows, rules, "hostname", "name").select("page_id", *shown("name"))


@query(
    "cert_matches_domain",
    f"""WITH p AS ({HOSTS}) SELECT page_id, CASE page_id % 8 WHEN 0 THEN true WHEN 1 THEN true WHEN 2 THEN false
      WHEN 3 THEN true WHEN 4 THEN false WHEN 5 THEN false WHEN 6 THEN false ELSE true END AS matches FROM p""",
)
def cert_matches(spark, sf):
    c = F.col
    host, kind = c("host"), c("page_id") % 8
    parent = F.regexp_extract(host, r"^[^.]+\.(.*)$", 1)
    domain = F.when(kind == 6, "9.8.7.6").otherwise(host)
    names = (
        F.when(kind == 0, F.array(F.lit("other.com"), F.upper(host)))
        .when(kind == 1, F.array(F.concat(F.lit("*."), parent)))
        .when(kind == 2, F.array(F.lit("*.*.com"), host))
        .when(kind == 3, F.array().cast("array<string>"))
        .when(kind == 4, F.array(F.concat(F.lit("*."), host)))
        .when(kind == 5, F.array(F.lit("other.com")))
        .when(kind == 6, F.array(F.lit("9.8.7.6")))
        .otherwise(F.array(host, F.lit("*.*.com")))
    )
    common = F.when(kind == 3, host).when(kind == 5, host)
    return relation(spark, sf, HOSTS).select("page_id", cert_matches_domain(names, common, domain).alias("matches"))


@query(
    "enrich_certificates",
    f"""WITH p AS ({HOSTS}),
    r AS (SELECT *, CASE WHEN page_id % 4 = 0 THEN '' WHEN page_id % 4 = 1 THEN NULL ELSE 'CERT' || page_id % 50 END AS cert FROM p)
    SELECT page_id, """
    + shown_sql(
        common_name="n_name",
        issuer="CASE WHEN cert <> '' THEN 'CA' || n_regionkey END",
        start_date="CASE WHEN n_name IS NOT NULL THEN '2021-01-0' || (1 + n_regionkey) || ' 00:00:00' END",
        names="CASE WHEN n_nationkey % 2 = 0 THEN 'a.com|*.example.org' ELSE '' END",
        matches="CASE WHEN cert <> '' THEN coalesce(n_nationkey % 2 = 0 AND host SIMILAR TO '[^.]+\\.example\\.org', false) END",
    )
    + " FROM r LEFT JOIN nation ON cert = 'CERT' || n_nationkey",
)
def certificates(spark, sf):
    c = F.col
    names = F.when(c("n_nationkey") % 2 == 0, F.array(F.lit("a.com"), F.lit("*.example.org"))).otherwise(
        F.array().cast("array<string>")
    )
    decoded = table(spark, sf, "nation").select(
        F.sha2(F.concat(F.lit("CERT"), c("n_nationkey").cast("string")), 256).alias("cert_sha"),
        c("n_name").alias("common_name"),
        F.concat(F.lit("CA"), c("n_regionkey").cast("string")).alias("issuer"),
        F.make_timestamp(F.lit(2021), F.lit(1), c("n_regionkey") + 1, F.lit(0), F.lit(0), F.lit(0)).alias("not_before"),
        F.make_timestamp(F.lit(2022), F.lit(1), c("n_regionkey") + 1, F.lit(0), F.lit(0), F.lit(0)).alias("not_after"),
        names.alias("sans"),
    )
    from scanlake.functions.records import response

    cert = F.when(c("page_id") % 4 == 0, "").when(
        c("page_id") % 4 > 1, F.concat(F.lit("CERT"), (c("page_id") % 50).cast("string"))
    )
    rows = relation(spark, sf, HOSTS).select(
        "page_id", c("host").alias("domain"), response(tls_cert=cert).alias("received")
    )
    r = enrich_certificates(rows, decoded)
    return r.select(
        "page_id",
        *shown(
            common_name=c("received.tls_cert_common_name"),
            issuer=c("received.tls_cert_issuer"),
            start_date=c("received.tls_cert_start_date"),
            names=F.array_join("received.tls_cert_alternative_names", "|"),
            matches=c("received.tls_cert_matches_domain"),
        ),
    )


CERTIFIED = "SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 9 = 8 THEN 1 ELSE c_custkey END AS cert_of FROM {customer}"


def _certificate_texts(batches):
    """The certificates of customers: some cut off, no base64, or of a version that is none."""
    for batch in batches:
        frame, texts = batch.to_pandas(), []
        for key, name, nation, of in frame[["c_custkey", "c_name", "c_nationkey", "cert_of"]].itertuples(index=False):
            name, nation = (name, nation) if of == key else ("Customer#000000001", 0)
            names = [f"n{nation}.example.org", "*.a.com"] if of % 2 else []
            text = certificate_text(name, f"CA{nation}", f"2101{1 + nation:02}000000Z", "20510630235959Z", names, version=2 if of % 7 == 2 else 3)
            texts.append({0: text[: len(text) // 2 // 4 * 4], 1: "?" + text}.get(of % 7, text) if of != 1 else text)
        yield pa.RecordBatch.from_arrays([batch.column("c_custkey").cast(pa.int64()), pa.array(texts, pa.string())], names=["c_custkey", "tls_cert"])


@query(
    "decode_certificates",
    f"""WITH c AS (SELECT c_custkey, cert_of, CASE WHEN cert_of = c_custkey THEN c_name ELSE 'Customer#000000001' END AS name,
      CASE WHEN cert_of = c_custkey THEN c_nationkey ELSE 0 END AS nation FROM ({CERTIFIED})),
    g AS (SELECT *, cert_of = 1 OR cert_of % 7 > 2 AS good FROM c)
    SELECT c_custkey, """
    + shown_sql(
        common_name="CASE WHEN good THEN name END", issuer="CASE WHEN good THEN 'CA' || nation END",
        not_before="CASE WHEN good THEN '2021-01-' || lpad(CAST(1 + nation AS VARCHAR), 2, '0') || 'T00:00:00' END",
        not_after="CASE WHEN good THEN '2051-06-30T23:59:59' END",
        sans="CASE WHEN good THEN CASE WHEN cert_of % 2 = 1 THEN 'n' || nation || '.example.org|*.a.com' ELSE '' END END",
    )
    + " FROM g",
)
def decoded_certificates(spark, sf):
    texts = relation(spark, sf, CERTIFIED).mapInArrow(_certificate_texts, "c_custkey BIGINT, tls_cert STRING")
    keyed = texts.withColumn("cert_sha", cert_key(F.col("tls_cert")))
    joined = lookup_join(keyed, decode_certificates(texts), ["cert_sha"])
    return joined.select("c_custkey", *shown("common_name", "issuer", "not_before", "not_after", sans=F.array_join("sans", "|")))


HARMLESS = [Signature("<video[^>]*autoplay", "a_fp_video"), Signature(r"Is and \w+ing ouen", "b_fp_text")]
BLOCKED = [
    Signature(r"track\(1[0-9]*\).*</table>", "a_block_table"),
    Signature(r"<title>[^<]*%%%", "b_block_title"),
    Signature(r"the .* by .* of", "c_block_words"),
    Signature("copyright|license", "d_block_notice"),
    Signature(r"ouen{,1} ", "e_block_quantifier"),
    Signature(r"(?i)LEON EN", "f_block_case"),
    Signature(r"(on|er|th)\1", "g_block_reference"),
    Signature(r"{font|<div class={,2}", "h_block_brace"),
]
#: What the other engine's pattern language says otherwise.
OTHERWISE = {
    "e_block_quantifier": "oue(n|) ",
    "g_block_reference": "onon|erer|thth",
    "h_block_brace": r"\{font|<div class(=){0,2}",
}


def _search_sql(signatures, column: str) -> str:
    cases = " ".join(
        f"WHEN regexp_matches({column}, '{OTHERWISE.get(s.fingerprint, s.pattern)}', 's') THEN '{s.fingerprint}'" for s in signatures
    )
    return f"CASE {cases} END"


_TEXTS = """SELECT 'page' AS kind, page_id AS id, html AS page FROM {pages}
  UNION ALL SELECT 'document', doc_id, text FROM {documents}"""


@query(
    "match_signatures",
    f"""WITH t AS ({_TEXTS}), m AS (SELECT kind, id, id % 9 = 4 AS calm, {_search_sql(HARMLESS, "page")} AS harmless,
      {_search_sql(BLOCKED, "page")} AS blocked FROM t)
    SELECT kind, id, """
    + shown_sql(
        known="CASE WHEN calm THEN NULL WHEN harmless IS NOT NULL THEN false WHEN blocked IS NOT NULL THEN true END",
        fingerprint="CASE WHEN NOT calm THEN coalesce(harmless, blocked) END",
    )
    + " FROM m",
)
def signatures(spark, sf):
    rows = relation(spark, sf, _TEXTS)
    anomaly = F.col("id") % 9 != 4
    found = rows.select("kind", "id", match_signatures(F.col("page"), anomaly, HARMLESS, BLOCKED).alias("m"))
    return found.select(
        "kind", "id", *shown(known=F.col("m.is_known_blockpage"), fingerprint=F.col("m.page_signature"))
    )
