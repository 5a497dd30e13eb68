"""Flatteners: raw lines are rendered from the tables and parsed back by the operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.common import MEASUREMENTS, query, relation, shown, shown_sql, table
from scanlake.functions.text import (
    domain_from_request,
    flatten_headers,
    iso_timestamp,
    measurement_id,
)
from scanlake.operators.dns import (
    flatten_dns_control,
    flatten_dns_retries,
    flatten_dns_roundtrips,
    flatten_dns_v1,
)
from scanlake.operators.lines import route_by_filename, skip_malformed
from scanlake.operators.pages import flatten_page_fetch
from scanlake.operators.probe import flatten_probe_v1, flatten_probe_v2
from scanlake.operators.received import add_received
from scanlake.operators.tags import country_name_to_code, read_resolver_tags


def json_text(**fields: Column) -> Column:
    """JSON object text; null fields are left out."""
    return F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))


def with_raw(text: Column, **raw: Column) -> Column:
    """Add fields whose values are JSON text already; null ones are left out.

    They are put before the others, so that object and values are rendered once each.
    """
    first = [F.coalesce(F.concat(F.lit(f'"{name}":'), value, F.lit(",")), F.lit("")) for name, value in raw.items()]
    return F.concat(F.lit("{"), *first, F.substring(text, 2, 2**31 - 1))


def quoted(text: Column) -> Column:
    """JSON text of a text without characters that are escaped."""
    return F.concat(F.lit('"'), text, F.lit('"'))


def object_text(**values: Column) -> Column:
    """JSON object text of values that are JSON text or print as it; null ones are left out.

    Same text as ``json_text`` and ``with_raw``, without a writer for each object.
    """
    return F.concat(F.lit("{"), F.concat_ws(",", *[F.concat(F.lit(f'"{n}":'), c.cast("string")) for n, c in values.items()]), F.lit("}"))


def json_list(items: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(items, ","), F.lit("]"))


def s(*parts) -> Column:
    return F.concat(*[(p if isinstance(p, Column) else F.lit(p)).cast("string") for p in parts])


def steps(count: Column) -> Column:
    """0 … count - 1, empty for 0."""
    return F.filter(F.sequence(F.lit(0), count.cast("int")), lambda i: i < count)


def payload(i: Column, key: str) -> Column:
    """JSON text of a response object, of a text that looks like one, or nothing."""
    kind = (F.col("l_suppkey") + i) % 3
    headers = s('{"Server":["s', F.col("l_suppkey"), '","t"],"Age":["', i, '"]}')
    thing = object_text(status_line=F.lit('"403 Forbidden"'), headers=headers, body=quoted(s("body", i)))
    text = s('"{\\"', key, '\\":{', i, '}"')
    return F.when(kind == 0, thing).when(kind == 1, text)


# SQL counterparts of payload: status, body and headers of roundtrip i.
PAYLOAD_SQL = {
    key: {
        "status": f"CASE (l_suppkey + i) % 3 WHEN 0 THEN '403 Forbidden' WHEN 1 THEN '{{{{\"{key}\":{{{{' || i || '}}}}' END",
        "body": "CASE (l_suppkey + i) % 3 WHEN 0 THEN 'body' || i END",
        "headers": "CASE (l_suppkey + i) % 3 WHEN 0 THEN 'Server: s' || l_suppkey || '|Server: t|Age: ' || i ELSE '' END",
    }
    for key in ("Received", "response")
}
for _fields in PAYLOAD_SQL.values():
    _fields["status"] = _fields["status"].replace("{{", "{").replace("}}", "}")

ROUNDTRIPS = f"""
WITH m AS ({MEASUREMENTS}),
t AS (SELECT m.*, unnest(range(n % 4)) AS i FROM m)
"""


def probe_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        *shown(
            "domain", "ip", "date", "start_time", "retry", "error", "anomaly", "success", "is_control",
            "controls_failed", "stateful_block", "source",
            status=F.col("received.status"),
            body=F.col("received.body"),
            headers=F.array_join("received.headers", "|"),
        )
    )


_SENT_KIND = "(l_orderkey + i) % 5"
_V1_DOMAIN = f"""CASE {_SENT_KIND}
  WHEN 0 THEN 'd' || l_partkey || '.com'
  WHEN 1 THEN 'www.x' || l_partkey || '.com/p' || i
  WHEN 2 THEN 'site' || l_partkey || '.org'
  WHEN 3 THEN CASE WHEN i > n % 2 THEN '' ELSE 'kw' || l_partkey || '.com' END
  ELSE 'example5718349450314.com' END"""
_V1_CONTROL = f"({_SENT_KIND} = 4 OR ({_SENT_KIND} = 3 AND i > n % 2))"


@query(
    "flatten_probe_v1",
    ROUNDTRIPS
    + "SELECT "
    + shown_sql(
        domain=_V1_DOMAIN,
        ip="'10.0.0.' || l_suppkey % 256",
        date="day",
        start_time="day || 'T00:00:0' || i || '.5Z'",
        retry=f"CASE WHEN NOT {_V1_CONTROL} THEN i END",
        error="CASE WHEN flag = 'R' THEN 'err' || i END",
        anomaly="flag = 'R'",
        success="flag = 'N'",
        is_control=_V1_CONTROL,
        controls_failed="status = 'O'",
        stateful_block="false",
        source="'Quack-https-' || day",
        **PAYLOAD_SQL["Received"],
    )
    + " FROM t",
)
def probe_v1(spark, sf):
    c = F.col

    def roundtrip(i):
        kind = (c("l_orderkey") + i) % 5
        sent = (
            F.when(kind == 0, s("GET / HTTP/1.1\r\nHost: d", c("l_partkey"), ".com\r\n\r\n"))
            .when(kind == 1, s("GET www.x", c("l_partkey"), ".com HTTP/1.1\r\nHost: /p", i, "\r\n\r\n"))
            .when(kind == 2, s("site", c("l_partkey"), ".org"))
            .when(kind == 3, s(""))
            .otherwise(s("example5718349450314.com"))
        )
        base = json_text(
            Sent=sent,
            Success=c("flag") == "N",
            Error=F.when(c("flag") == "R", s("err", i)),
            StartTime=s(c("day"), "T00:00:0", i, ".5Z"),
            EndTime=s(c("day"), "T00:00:09Z"),
        )
        return with_raw(base, Received=payload(i, "Received"))

    top = json_text(
        Server=s("10.0.0.", c("l_suppkey") % 256),
        Keyword=s("kw", c("l_partkey"), ".com"),
        Retries=c("n") % 2,
        Blocked=c("flag") == "R",
        FailSanity=c("status") == "O",
        StatefulBlock=F.lit(False),
    )
    lines = relation(spark, sf, MEASUREMENTS).select(
        s("scans/Quack-https-", c("day"), "/results.json").alias("file_path"),
        with_raw(top, Results=json_list(F.transform(steps(c("n") % 4), roundtrip))).alias("value"),
    )
    return probe_rows(flatten_probe_v1(lines))


def probe_v2_lines(spark, sf, *extra: str) -> DataFrame:
    c = F.col

    def roundtrip(i):
        return object_text(
            response=payload(i, "response"),
            matches_template=c("flag") == "N",
            control_url=F.when((c("l_partkey") + i) % 3 == 0, quoted(s("control", i, ".com"))),
            error=F.when(c("flag") == "A", quoted(s("first", i, ";second"))),
            start_time=quoted(s(c("day"), "T00:00:0", i, "Z")),
            end_time=quoted(s(c("day"), "T00:00:09Z")),
        )

    line = object_text(
        response=json_list(F.transform(steps(c("n") % 4), roundtrip)),
        vp=quoted(s("10.1.0.", c("l_suppkey") % 256)),
        test_url=quoted(s("test", c("l_partkey"), ".net")),
        anomaly=c("flag") == "R",
        controls_failed=F.when(c("l_suppkey") % 7 != 0, c("status") == "O"),
        stateful_block=c("l_suppkey") % 2 == 0,
    )
    return relation(spark, sf, MEASUREMENTS).select(
        s("scans/Quack-http-", c("day"), "/results.json.gz").alias("file_path"),
        line.alias("value"),
        *extra,
    )


@query(
    "flatten_probe_v2",
    ROUNDTRIPS
    + "SELECT "
    + shown_sql(
        domain="CASE WHEN (l_partkey + i) % 3 = 0 THEN 'control' || i || '.com' ELSE 'test' || l_partkey || '.net' END",
        ip="'10.1.0.' || l_suppkey % 256",
        date="day",
        start_time="day || 'T00:00:0' || i || 'Z'",
        retry="""CASE WHEN (l_partkey + i) % 3 <> 0 THEN
          i - (CASE WHEN i > 0 AND l_partkey % 3 = 0 THEN 1 ELSE 0 END)
            - (CASE WHEN i > 1 AND (l_partkey + 1) % 3 = 0 THEN 1 ELSE 0 END) END""",
        error="CASE WHEN flag = 'A' THEN 'first' || i || ';second' END",
        anomaly="flag = 'R'",
        success="flag = 'N'",
        is_control="(l_partkey + i) % 3 = 0",
        controls_failed="CASE WHEN l_suppkey % 7 <> 0 THEN status = 'O' END",
        stateful_block="l_suppkey % 2 = 0",
        source="'Quack-http-' || day",
        **PAYLOAD_SQL["response"],
    )
    + " FROM t",
)
def probe_v2(spark, sf):
    return probe_rows(flatten_probe_v2(probe_v2_lines(spark, sf)))


def flags_text(flags: Column) -> Column:
    return F.concat_ws(
        "+", *[F.when(flags[f], F.lit(f)) for f in ("ip", "http", "cert", "asnum", "asname")]
    )


def dns_rows(rows: DataFrame, *extra: str) -> DataFrame:
    """Row fields and, as one text each, what the answers say."""
    c = F.col
    return rows.select(
        *shown(
            "domain", "ip", "date", "retry", "error", "anomaly", "success", "is_control", "is_control_ip",
            "controls_failed", "rcode", "source", *extra,
            country=c("ip_metadata.country"),
            answers=F.array_join(F.transform("received", lambda a: F.concat(a["ip"], F.lit("="), flags_text(a["matches_control"]))), "|"),
        )
    )


_DNS_V1_FAILED = "l_orderkey % 4 = 0"


@query(
    "flatten_dns_v1",
    f"WITH m AS ({MEASUREMENTS}) SELECT "
    + shown_sql(
        domain="'q' || l_partkey || '.com'",
        ip="'8.0.0.' || l_suppkey % 256",
        date="'2020' || SUBSTR(day, 5)",
        retry="0",
        error=f"CASE WHEN {_DNS_V1_FAILED} THEN CASE WHEN flag = 'R' THEN '{{\"Err\": {{}}, \"Op\": \"a:b,c\"}}' ELSE 'no_answer' END END",
        anomaly="CASE WHEN flag <> 'N' THEN NOT (flag = 'A') END",
        success=f"NOT ({_DNS_V1_FAILED})",
        is_control="false",
        is_control_ip="status = 'O'",
        controls_failed="false",
        rcode=f"CASE WHEN {_DNS_V1_FAILED} THEN -1 ELSE 0 END",
        source="'Satellite-2020' || SUBSTR(day, 5)",
        country="CAST(NULL AS VARCHAR)",
        answers="""CASE n % 3
          WHEN 0 THEN '30.0.0.' || l_partkey % 200 || '=ip+cert|2.0.0.' || l_suppkey % 200 || '='
          WHEN 1 THEN '30.0.0.' || l_partkey % 200 || '=|2.0.0.' || l_suppkey % 200 || '='
          ELSE '' END""",
    )
    + " FROM m",
)
def dns_v1(spark, sf):
    c = F.col
    first, second = s("30.0.0.", c("l_partkey") % 200), s("2.0.0.", c("l_suppkey") % 200)
    answers = (
        F.when(c("n") % 3 == 0, s('{"', first, '":["ip","cert"],"', second, '":[]}'))
        .when(c("n") % 3 == 1, s('["', first, '","', second, '"]'))
        .otherwise("null")
    )
    error = F.when(
        c("l_orderkey") % 4 == 0,
        F.when(c("flag") == "R", '{"Err":{},"Op":"a:b,c"}').otherwise('"no_answer"'),
    )
    # Half of the lines name the resolver by its older key.
    ip = s("8.0.0.", c("l_suppkey") % 256)
    top = json_text(
        resolver=F.when(c("l_suppkey") % 2 == 0, ip),
        ip=F.when(c("l_suppkey") % 2 == 1, ip),
        query=s("q", c("l_partkey"), ".com"),
        passed=F.when(c("flag") != "N", c("flag") == "A"),
    )
    name = F.when(c("status") == "O", "answers_control.json").otherwise("interference.json.gz")
    lines = relation(spark, sf, MEASUREMENTS).select(
        s("dns/Satellite-2020", F.substring("day", 5, 6), "/", name).alias("file_path"),
        with_raw(top, answers=answers, error=error).alias("value"),
    )
    return dns_rows(flatten_dns_v1(lines))


def v2_top(ip: Column, domain: Column, **more: Column) -> dict[str, Column]:
    c = F.col
    stamp = s(c("day"), " 10:00:00.25 -0400 EDT m=+1.5")
    return {
        "vp": ip,
        "test_url": domain,
        "location": F.struct(s("C", c("l_suppkey") % 5).alias("country_code")),
        "connect_error": c("flag") == "A",
        "anomaly": c("flag") == "R",
        "start_time": stamp,
        # Some lines lack the end time and are dropped.
        "end_time": F.when(c("cents") % 50 == 0, s(" ")).otherwise(stamp),
        **more,
    }


_V2_BASE_SQL = {
    "ip": "CASE WHEN l_suppkey % 9 = 0 THEN '1.1.1.1' ELSE '9.9.0.' || l_suppkey % 256 END",
    "date": "day",
    "start_time": "day || 'T10:00:00.25-04:00'",
    "anomaly": "flag = 'R'",
    "is_control_ip": "l_suppkey % 9 = 0",
    "controls_failed": "status = 'O'",
    "country": "'C' || l_suppkey % 5",
}
_V2_DOMAIN_SQL = "CASE WHEN l_partkey % 11 = 0 THEN 'www.example.com' ELSE 'r' || l_partkey || '.com' END"


def _v2_ip() -> Column:
    return F.when(F.col("l_suppkey") % 9 == 0, "1.1.1.1").otherwise(s("9.9.0.", F.col("l_suppkey") % 256))


def _v2_domain() -> Column:
    return F.when(F.col("l_partkey") % 11 == 0, "www.example.com").otherwise(
        s("r", F.col("l_partkey"), ".com")
    )


# What a line of several tries holds, by case: codes, errors, addresses; and the
# expected rows as (retry, code, error, answers).
_TRIES = [
    ([], [], [], [(0, None, None, "")]),
    (["0"], [], ["40.0.0.1", "4.0.0.2"], [(0, 0, None, "40.0.0.1=ip+http|4.0.0.2=")]),
    (["-1", "2", "-1", "0"], ["e1"], ["40.0.0.3"],
     [(0, -1, "e1", ""), (1, 2, None, ""), (2, -1, None, ""), (3, 0, None, "40.0.0.3=ip+http")]),
    (["-1", "-1"], ["e1", "e2"], [], [(0, -1, "e1", ""), (1, -1, "e2", "")]),
    (["3"], ["e1", "e2"], [], [(0, 3, None, ""), (1, -1, "e1", ""), (2, -1, "e2", "")]),
    (["-1"], ["e1"], ["40.0.0.4"], []),
]


def _tries_text(codes, errors, addresses) -> str:
    import json

    entries: dict = {ip: (["ip", "http"] if ip.startswith("40.") else []) for ip in addresses}
    if codes:
        entries["rcode"] = codes
    if errors:
        entries["error"] = errors
    return json.dumps(entries)


_TRY_ROWS = ", ".join(
    f"({case}, {retry}, {'NULL' if code is None else code}, {'NULL' if error is None else repr(error)}, {answers!r})"
    for case, (_, _, _, expected) in enumerate(_TRIES)
    for retry, code, error, answers in expected
)


@query(
    "flatten_dns_retries",
    f"""WITH m AS ({MEASUREMENTS}),
    x(tcase, tretry, tcode, terror, tanswers) AS (VALUES {_TRY_ROWS})
    SELECT """
    + shown_sql(
        **_V2_BASE_SQL,
        domain=_V2_DOMAIN_SQL,
        retry="tretry",
        error="terror",
        success="flag <> 'A'",
        is_control="l_partkey % 11 = 0",
        rcode="tcode",
        source="'Satellite-' || day",
        answers="tanswers",
    )
    + f" FROM m JOIN x ON m.cents % {len(_TRIES)} = x.tcase WHERE cents % 50 <> 0",
)
def dns_retries(spark, sf):
    c = F.col
    response = F.get(
        F.array(*[F.lit(_tries_text(*case[:3])) for case in _TRIES]), (c("cents") % len(_TRIES)).cast("int")
    )
    top = json_text(**v2_top(_v2_ip(), _v2_domain(), passed_control=c("status") != "O"))
    lines = relation(spark, sf, MEASUREMENTS).select(
        s("dns/Satellite-", c("day"), "/results.json").alias("file_path"),
        with_raw(top, response=response).alias("value"),
    )
    return dns_rows(flatten_dns_retries(lines), "start_time")


@query(
    "flatten_dns_roundtrips",
    ROUNDTRIPS
    + ", u AS (SELECT *, (l_partkey + i) % 3 = 0 AS control, (n + i) % 4 AS answer_count FROM t) SELECT "
    + shown_sql(
        **_V2_BASE_SQL,
        domain="CASE WHEN control THEN 'a.root-servers.net' ELSE 'r' || l_partkey || '.com' END",
        retry="""CASE WHEN NOT control THEN
          i - (CASE WHEN i > 0 AND l_partkey % 3 = 0 THEN 1 ELSE 0 END)
            - (CASE WHEN i > 1 AND (l_partkey + 1) % 3 = 0 THEN 1 ELSE 0 END) END""",
        error="CASE WHEN i = 1 THEN 'read udp: i/o timeout' END",
        success="(l_suppkey + i) % 4 = 0",
        is_control="control",
        rcode="(l_suppkey + i) % 4",
        source="'Satellite-' || day",
        # Answers beyond the list of confidences are dropped, unless there is none.
        answers="""CASE WHEN answer_count = 0 THEN '' ELSE array_to_string([
            '50.0.' || i || '.' || (9 - j) || '=' || CASE WHEN j = 1 THEN 'ip+asnum' ELSE '' END
            FOR j IN range(CASE WHEN l_suppkey % 3 = 0 THEN answer_count ELSE least(answer_count, n % 3) END)], '|') END""",
        first_as="CASE WHEN answer_count > 0 AND (l_suppkey % 3 = 0 OR n % 3 > 0) THEN 'AS' || l_suppkey || ':' || (l_partkey % 1000) END",
        average_confidence="CASE WHEN answer_count > 0 THEN CAST(l_partkey % 101 AS INTEGER) END",
        has_type_a="CASE WHEN (l_suppkey + i) % 4 = 0 AND status = 'O' THEN true END",
        untagged_controls="flag = 'N'",
        excluded="CASE WHEN l_partkey % 2 = 0 THEN flag = 'R' ELSE false END",
        exclude_reason="CASE WHEN l_partkey % 2 = 0 THEN 'a b' ELSE '' END",
    )
    + " FROM u WHERE cents % 50 <> 0",
)
def dns_roundtrips(spark, sf):
    c = F.col

    def roundtrip(i):
        count = (c("n") + i) % 4

        def answer(j):
            body = json_text(
                http=s("h", j),
                asnum=c("l_partkey") % 1000,
                asname=s("AS", c("l_suppkey")),
                matched=F.when(j == 1, F.array(F.lit("ip"), F.lit("asnum"))),
            )
            return s('"50.0.', i, ".", 9 - j, '":', body)

        answers = s("{", F.array_join(F.transform(steps(count), answer), ","), "}")
        base = json_text(
            url=F.when((c("l_partkey") + i) % 3 == 0, "a.root-servers.net").otherwise(
                s("r", c("l_partkey"), ".com")
            ),
            has_type_a=c("status") == "O",
            error=F.when(i == 1, "read udp: i/o timeout").otherwise("null"),
            rcode=(c("l_suppkey") + i) % 4,
        )
        return with_raw(base, response=answers)

    confidence = F.struct(
        (c("l_partkey") % 101).alias("average"),
        F.when(c("l_suppkey") % 3 != 0, F.transform(steps(c("n") % 3), lambda i: i * 10)).alias("matches"),
        (c("flag") == "N").alias("untagged_controls"),
        F.lit(False).alias("untagged_response"),
    )
    even = c("l_partkey") % 2 == 0
    top = json_text(
        **v2_top(
            _v2_ip(),
            s("r", c("l_partkey"), ".com"),
            passed_liveness=c("status") != "O",
            confidence=confidence,
            excluded=F.when(even, c("flag") == "R"),
            exclude_reason=F.when(even, F.array(F.lit("a"), F.lit("b"))),
        )
    )
    lines = relation(spark, sf, MEASUREMENTS).select(
        s("dns/Satellite-", c("day"), "/results.json").alias("file_path"),
        with_raw(top, response=json_list(F.transform(steps(c("n") % 4), roundtrip))).alias("value"),
    )
    rows = flatten_dns_roundtrips(lines)
    first = F.get("received", F.lit(0))["ip_metadata"]
    rows = rows.withColumn("first_as", s(first["as_name"], ":", first["asn"])).withColumn(
        "average_confidence", c("average_confidence").cast("int")
    )
    return dns_rows(
        rows, "start_time", "first_as", "average_confidence", "has_type_a", "untagged_controls",
        "excluded", "exclude_reason",
    )


@query(
    "flatten_dns_control",
    ROUNDTRIPS
    + "SELECT "
    + shown_sql(
        domain="CASE WHEN (l_partkey + i) % 3 = 0 THEN 'gstatic.com' ELSE 'r' || l_partkey || '.com' END",
        ip="'8.8.8.8'",
        date="day",
        start_time="day || 'T10:00:0' || i || '.25-04:00'",
        retry="""CASE WHEN (l_partkey + i) % 3 <> 0 THEN
          i - (CASE WHEN i > 0 AND l_partkey % 3 = 0 THEN 1 ELSE 0 END)
            - (CASE WHEN i > 1 AND (l_partkey + 1) % 3 = 0 THEN 1 ELSE 0 END) END""",
        error="CASE WHEN i = 1 THEN 'timeout' END",
        anomaly="CAST(NULL AS VARCHAR)",
        success="flag <> 'A'",
        is_control="(l_partkey + i) % 3 = 0",
        is_control_ip="true",
        controls_failed="status = 'O'",
        rcode="i",
        source="'Satellite-' || day",
        has_type_a="status = 'O'",
        country="CAST(NULL AS VARCHAR)",
        answers="CASE WHEN flag = 'N' THEN '' ELSE '60.0.0.' || i || '=|6.0.0.1=' END",
    )
    + " FROM t",
)
def dns_control(spark, sf):
    c = F.col

    def roundtrip(i):
        stamp = s(c("day"), " 10:00:0", i, ".25 -0400 EDT m=+10979.5")
        return json_text(
            url=F.when((c("l_partkey") + i) % 3 == 0, "gstatic.com").otherwise(s("r", c("l_partkey"), ".com")),
            has_type_a=c("status") == "O",
            response=F.when(c("flag") != "N", F.array(s("60.0.0.", i), s("6.0.0.1"))),
            error=F.when(i == 1, "timeout").otherwise("null"),
            rcode=i,
            start_time=stamp,
            end_time=stamp,
        )

    top = json_text(
        vp=s("8.8.8.8"),
        test_url=s("r", c("l_partkey"), ".com"),
        passed_control=c("status") != "O",
        connect_error=c("flag") == "A",
    )
    lines = relation(spark, sf, MEASUREMENTS).select(
        s("dns/Satellite-", c("day"), "/responses_control.json").alias("file_path"),
        with_raw(top, response=json_list(F.transform(steps(c("n") % 4), roundtrip))).alias("value"),
    )
    return dns_rows(flatten_dns_control(lines), "start_time", "has_type_a")


_PAGE_SQL = """
WITH p AS (SELECT page_id, html, regexp_extract(url, '^https?://([^/?#]*)', 1) AS host FROM pages),
f AS (SELECT *, false AS https, page_id % 3 AS kind FROM p
      UNION ALL SELECT *, true, (page_id + 1) % 3 FROM p)
SELECT """


@query(
    "flatten_page_fetch",
    _PAGE_SQL
    + shown_sql(
        "https",
        domain="host",
        ip="'7.7.7.' || page_id % 256",
        date="'2022-01-02'",
        start_time="'2022-01-02T03:04:05.125-05:00'",
        success="page_id % 2 = 0",
        source="'Satellite-2022-01-02'",
        error="CASE WHEN kind = 1 THEN md5(html) || ' {\"http\":{' END",
        status="CASE WHEN kind = 0 THEN '200 OK' END",
        headers="CASE WHEN kind = 0 THEN 'X: ' || md5(html) ELSE '' END",
        body="CAST(NULL AS VARCHAR)",
        tls_version="CASE WHEN kind = 0 AND https THEN 771 END",
        trusted="CASE WHEN kind = 0 AND https THEN page_id % 5 = 0 END",
    )
    + " FROM f",
)
def page_fetch(spark, sf):
    c = F.col

    def fetched(kind: Column, https: bool) -> Column:
        response = json_text(
            status_line=s("200 OK"),
            headers=F.create_map(F.lit("X"), F.array(F.md5("html"))),
            body=c("html"),
            **({"TlsVersion": F.lit(771)} if https else {}),
        )
        text = s('"', F.md5("html"), ' {\\"http\\":{"')
        return F.when(kind == 0, response).when(kind == 1, text)

    stamp = s("2022-01-02 03:04:05.125 -0500 EST m=+2")
    top = json_text(
        ip=s("7.7.7.", c("page_id") % 256),
        keyword=F.regexp_extract("url", "^https?://([^/?#]*)", 1),
        fetched=c("page_id") % 2 == 0,
        trusted_cert=c("page_id") % 5 == 0,
        start_time=stamp,
        end_time=stamp,
    )
    lines = table(spark, sf, "pages").select(
        s("dns/Satellite-2022-01-02/blockpages.json.gz").alias("file_path"),
        with_raw(
            top, http=fetched(c("page_id") % 3, False), https=fetched((c("page_id") + 1) % 3, True)
        ).alias("value"),
    )
    return flatten_page_fetch(lines).select(
        *shown(
            "https", "domain", "ip", "date", "start_time", "success", "source", "error",
            status=c("received.status"),
            headers=F.array_join("received.headers", "|"),
            body=c("received.body"),
            tls_version=c("received.tls_version"),
            trusted=c("received.tls_cert_has_trusted_ca"),
        )
    )


@query(
    "parse_received",
    """SELECT page_id, """
    + shown_sql(
        status="CASE page_id % 4 WHEN 0 THEN html ELSE 'S ' || page_id END",
        body="CASE WHEN page_id % 4 > 0 THEN html END",
        tls_version="CASE page_id % 4 WHEN 2 THEN 771 WHEN 3 THEN 772 END",
        tls_cipher_suite="CASE page_id % 4 WHEN 2 THEN 5 WHEN 3 THEN 6 END",
        tls_cert="CASE page_id % 4 WHEN 2 THEN 'old' WHEN 3 THEN CASE page_id % 3 WHEN 0 THEN 'one' WHEN 1 THEN 'first' END END",
        headers="CASE WHEN page_id % 4 > 0 THEN 'H: a|H: b' ELSE '' END",
    )
    + " FROM pages",
)
def received(spark, sf):
    c = F.col
    kind = c("page_id") % 4
    certificate = (
        F.when(c("page_id") % 3 == 0, '"one"').when(c("page_id") % 3 == 1, '["first","second"]').otherwise("[]")
    )
    base = json_text(
        status_line=s("S ", c("page_id")),
        headers=F.create_map(F.lit("H"), F.array(F.lit("a"), F.lit("b"))),
        body=c("html"),
        tls=F.when(
            kind == 2, F.struct(F.lit(771).alias("version"), F.lit(5).alias("cipher_suite"), F.lit("old").alias("cert"))
        ),
        TlsVersion=F.when(kind == 3, 772),
        CipherSuite=F.when(kind == 3, 6),
    )
    thing = with_raw(base, Certificate=F.when(kind == 3, certificate))
    text = F.when(kind == 0, c("html")).otherwise(thing)
    rows = table(spark, sf, "pages").select("page_id", text.alias("payload"), (kind != 0).alias("is_object"))
    parsed = add_received(rows, "payload", "is_object", into="r")
    return parsed.select(
        "page_id",
        *shown(
            **{f: c(f"r.{f}") for f in ("status", "body", "tls_version", "tls_cipher_suite", "tls_cert")},
            headers=F.array_join("r.headers", "|"),
        ),
    )


@query(
    "flatten_headers",
    """SELECT page_id, 'Host: ' || url || '|Kind: ' || (page_id % 7) || '|Kind: md5 ' || md5(html)
       || CASE WHEN page_id % 2 = 0 THEN '' ELSE '|Odd: x' END AS headers FROM pages""",
)
def headers(spark, sf):
    c = F.col
    base = [F.lit("Host"), F.array("url"), F.lit("Kind"), F.array(s(c("page_id") % 7), s("md5 ", F.md5("html")))]
    odd = [F.lit("Odd"), F.array(F.lit("x"))]
    none = [F.lit("Odd"), F.array().cast("array<string>")]
    named = F.when(c("page_id") % 2 == 0, F.create_map(*base, *none)).otherwise(F.create_map(*base, *odd))
    return table(spark, sf, "pages").select(
        "page_id", F.array_join(flatten_headers(named), "|").alias("headers")
    )


@query(
    "json_skip_malformed",
    """SELECT event_id, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k
       FROM events WHERE event_type <> 'error'""",
)
def malformed(spark, sf):
    # Lines of failed events are cut short and are no JSON any more.
    text = F.when(F.col("event_type") == "error", F.expr("left(props, length(props) - 1)")).otherwise(F.col("props"))
    lines = table(spark, sf, "events").select("event_id", F.lit("f").alias("file_path"), text.alias("value"))
    return skip_malformed(lines, "k BIGINT, _corrupt_record STRING").select("event_id", "scan.k")


_FILES = [
    ("tagged_answers.json", "answer_tags"), ("tagged_responses.json.gz", "answer_tags"),
    ("resolvers.json", "resolver_tags"), ("tagged_resolvers.json.gz", "resolver_tags"),
    ("resolvers_profile.json", "resolver_tags"), ("blockpages.json", "page_fetches"),
    ("control_pages.json.gz", "page_fetches"), ("interference.json", "observations"),
    ("interference_err.json", "observations"), ("answers_control.json.gz", "observations"),
    ("responses_control.json", "observations"), ("results.json.gz", "observations"),
    ("answers_err.json", "observations"),
]


@query(
    "route_by_filename",
    f"""SELECT list_extract([{", ".join(repr(k) for _, k in _FILES)}], CAST(event_id % {len(_FILES)} + 1 AS INTEGER)) AS kind,
        CAST(count(*) AS BIGINT) AS lines, CAST(sum(length(props)) AS BIGINT) AS characters
        FROM events GROUP BY 1""",
)
def routed(spark, sf):
    names = F.array(*[F.lit("d/Satellite-2022-01-01/" + name) for name, _ in _FILES])
    lines = table(spark, sf, "events").select(
        F.get(names, (F.col("event_id") % len(_FILES)).cast("int")).alias("file_path"),
        F.col("props").alias("value"),
    )
    parts = [part.withColumn("kind", F.lit(kind)) for kind, part in route_by_filename(lines).items()]
    whole = parts[0].union(parts[1]).union(parts[2]).union(parts[3])
    return whole.groupBy("kind").agg(
        F.count("*").alias("lines"), F.sum(F.length("value")).cast("bigint").alias("characters")
    )


@query(
    "read_resolver_tags",
    """SELECT c_custkey, """
    + shown_sql(
        source="'Satellite-2021-10-20'",
        ip="'11.0.' || c_custkey",
        name="CASE WHEN c_custkey % 3 > 0 THEN c_name END",
        country="""CASE c_custkey % 4 WHEN 0 THEN 'C' || c_nationkey
          WHEN 1 THEN CASE WHEN c_nationkey < 25 THEN 'N' || c_nationkey END
          WHEN 2 THEN 'Atlantis' END""",
        non_zero_rcode_rate="CASE WHEN c_custkey % 2 = 0 THEN '0.25' END",
        invalid_cert_rate="CASE WHEN c_custkey % 5 = 0 THEN '0.5' END",
    )
    + " FROM customer",
)
def resolver_tags(spark, sf):
    c = F.col
    kind = c("c_custkey") % 4
    ip = s("11.0.", c("c_custkey"))
    text = json_text(
        resolver=F.when(c("c_custkey") % 2 == 0, ip),
        vp=F.when(c("c_custkey") % 2 == 1, ip),
        name=F.when(c("c_custkey") % 3 > 0, c("c_name")),
        location=F.when(kind == 0, F.struct(s("C", c("c_nationkey")).alias("country_code"))),
        country=F.when(kind == 1, s("NATION_", c("c_nationkey"))).when(kind == 2, "Atlantis"),
        non_zero_rcode=F.when(c("c_custkey") % 2 == 0, "0.2500"),
        invalid_cert=F.when(c("c_custkey") % 5 == 0, "0.5000"),
    )
    lines = table(spark, sf, "customer").select(
        s("d/Satellite-2021-10-20/resolvers.json").alias("file_path"), text.alias("value")
    )
    names = table(spark, sf, "nation").select(
        c("n_name").alias("country_name"), s("N", c("n_nationkey")).alias("country_code")
    )
    tags = read_resolver_tags(lines, names)
    return tags.select(
        F.regexp_extract("ip", r"(\d+)$", 1).cast("bigint").alias("c_custkey"),
        *shown("source", "ip", "name", "country", "non_zero_rcode_rate", "invalid_cert_rate"),
    )


@query(
    "country_name_to_code",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'Nowhere ' || c_nationkey ELSE 'N' || c_nationkey END AS country
       FROM customer""",
)
def country_codes(spark, sf):
    c = F.col
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(c("c_custkey") % 3 == 0, s("Nowhere ", c("c_nationkey"))).otherwise(s("NATION_", c("c_nationkey"))).alias("country"),
    )
    names = table(spark, sf, "nation").select(
        c("n_name").alias("country_name"), s("N", c("n_nationkey")).alias("country_code")
    )
    return country_name_to_code(rows, names, "country")


@query(
    "measurement_id",
    """SELECT event_id, substr(d, 1, 12) || '5' || substr(d, 14, 3)
         || translate(substr(d, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(d, 18, 15) AS measurement_id
       FROM (SELECT event_id, sha1(unhex('e49764863ca753b9b125cfb6dabec780')
               || encode('scans/' || event_type || '/results.json' || props || event_id)) AS d FROM events)""",
)
def ids(spark, sf):
    return table(spark, sf, "events").select(
        "event_id",
        measurement_id(
            s("scans/", F.col("event_type"), "/results.json"), s(F.col("props"), F.col("event_id"))
        ).alias("measurement_id"),
    )


@query(
    "domain_from_request",
    "SELECT event_id, "
    + shown_sql(
        domain="""CASE event_id % 5 WHEN 0 THEN 'u' || user_id || '.com' WHEN 1 THEN 'u' || user_id || '.com/' || event_type
          WHEN 2 THEN 'www.u' || user_id || '.com/x.html' WHEN 3 THEN 'plain' || user_id || '.org/p?q' END"""
    )
    + " FROM events",
)
def requests(spark, sf):
    c = F.col
    kind = c("event_id") % 5
    host = s("u", c("user_id"), ".com")
    sent = (
        F.when(kind == 0, s("GET / HTTP/1.1\r\nHost: ", host, "\r\n\r\n"))
        .when(kind == 1, s("GET /", c("event_type"), " HTTP/1.1\r\nHost: ", host, "\r\n"))
        .when(kind == 2, s("GET www.", host, " HTTP/1.1\r\nHost: /x.html\r\n"))
        .when(kind == 3, s("plain", c("user_id"), ".org/p?q"))
        .otherwise("")
    )
    return table(spark, sf, "events").select("event_id", *shown(domain=domain_from_request(sent)))


@query(
    "parse_go_timestamp",
    """SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.' || (event_id % 1000) || '001'
         || CASE WHEN event_id % 2 = 0 THEN '-04:00' ELSE '+05:30' END AS iso,
       strftime(ts + CASE WHEN event_id % 2 = 0 THEN INTERVAL 240 MINUTE ELSE INTERVAL (-330) MINUTE END, '%Y-%m-%d %H:%M:%S') AS instant
       FROM events""",
)
def go_times(spark, sf):
    c = F.col
    zone = F.when(c("event_id") % 2 == 0, "-0400 EDT").otherwise("+0530 IST")
    text = s(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), ".", c("event_id") % 1000, "001 ", zone, " m=+10140.555964129"
    )
    iso = table(spark, sf, "events").select("event_id", iso_timestamp(text).alias("iso"))
    return iso.select(
        "event_id", "iso", F.date_format(c("iso").cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias("instant")
    )

