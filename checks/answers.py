"""DNS rows with answers: tags, metadata, page fetches, confidence, outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from checks.common import (
    MEASUREMENTS,
    query,
    relation,
    rounded,
    rounded_sql,
    shown,
    shown_sql,
)
from checks.flatten import s, steps
from checks.networks import DAYS, lookup_of, lookup_sql
from scanlake.functions.dns import all_true, answers_signature, any_true, dns_outcome
from scanlake.functions.ips import long_to_ip
from scanlake.functions.records import ip_metadata, record, response
from scanlake.operators.answers import (
    answer_ip_keys,
    join_answer_ip_metadata,
    join_answer_tags,
    join_page_fetches,
    join_resolver_tags,
)
from scanlake.operators.barrier import explode_once
from scanlake.operators.postprocess import (
    broadcast_control_counts,
    dns_confidence,
    exclude_cdn,
    max_control_tags,
    postprocess,
)
from scanlake.operators.reduce import capable_domains
from scanlake.operators.resolvers import RATES, resolver_error_rates
from scanlake.operators.tables import dns_table, export_projection, table_answer
from scanlake.sources.sinks import let_go, stage
from scanlake.operators.tags import read_answer_tags
from scanlake.schemas import ANSWER_FIELDS, MATCHES_CONTROL_FIELDS

# Rows: one per line item. Columns that need no arrays are shared SQL.
ROWS = f"""SELECT m.*,
    md5(l_orderkey || '|' || l_partkey || '|' || l_suppkey || '|' || n || '|' || cents || flag || status || day) AS measurement_id,
    'sat-' || n % 3 AS source, 'site' || l_partkey % 40 || '.example.com' AS domain,
    '9.' || l_suppkey % 200 || '.' || n || '.7' AS ip,
    status = 'O' AND n % 4 = 0 AS is_control, l_suppkey % 5 = 0 AS is_control_ip,
    CASE flag WHEN 'R' THEN true WHEN 'A' THEN false END AS anomaly,
    CASE WHEN cents % 6 = 0 THEN 'read udp: i/o timeout' WHEN cents % 6 = 1 THEN 'SERVFAIL' END AS error,
    CASE cents % 9 WHEN 0 THEN -1 WHEN 1 THEN 3 WHEN 2 THEN 40 ELSE 0 END AS rcode
FROM ({MEASUREMENTS}) m"""

# Answer i of a row: its kind decides address and tags.
KIND = "(l_suppkey * 7 + l_partkey + i) % 97"
ANSWERS_SQL = f"""WITH rows AS ({ROWS}),
a AS (SELECT *, {KIND} AS k FROM (SELECT rows.*, unnest(range(n % 4)) AS i FROM rows)),
t AS (SELECT *,
    CASE k % 20 WHEN 0 THEN '0.0.' WHEN 1 THEN '127.0.' WHEN 2 THEN '10.1.' WHEN 3 THEN '172.20.' WHEN 4 THEN '192.168.' ELSE '20.' || k || '.' END || i || '.9' AS answer_ip,
    CASE WHEN k % 3 > 0 THEN 'h' || k END AS http, CASE WHEN k % 4 > 0 THEN 'c' || k END AS cert,
    CASE WHEN k % 5 > 0 THEN 1000 + k END AS asn,
    CASE WHEN k % 6 > 0 THEN CASE WHEN k % 7 = 0 THEN 'AMAZON-' || k ELSE 'NET' || k END END AS as_name,
    CASE WHEN k % 11 = 0 AND k % 13 > 0 THEN true END AS m_ip, CASE WHEN k % 2 = 0 AND k % 13 > 0 THEN true END AS m_http,
    CASE WHEN k % 3 = 1 AND k % 13 > 0 THEN true END AS m_cert, CASE WHEN k % 10 = 3 AND k % 13 > 0 THEN true END AS m_asnum,
    CASE WHEN k % 8 = 0 AND k % 13 > 0 THEN true END AS m_asname,
    CASE WHEN k % 9 > 2 THEN k % 9 < 6 END AS matches, CASE WHEN k % 10 > 2 THEN k % 10 < 7 END AS trusted,
    CASE WHEN k % 12 > 0 THEN 'CA' || k % 5 END AS issuer, CASE WHEN k % 14 > 0 THEN 'cn' || k END AS common_name,
    CASE WHEN k % 15 = 0 THEN true WHEN k % 15 < 4 THEN false END AS blockpage, 'fp' || k % 4 AS fingerprint
  FROM a)"""


def dns_rows(spark, sf, *extra: str) -> DataFrame:
    """The rows as flattened and enriched rows look, answers nested."""
    c = F.col
    base = relation(spark, sf, ROWS)

    def answer(place: Column) -> Column:
        i, k = place["i"], place["k"]
        start = F.coalesce(
            F.get(F.array(*[F.lit(p) for p in ("0.0.", "127.0.", "10.1.", "172.20.", "192.168.")]), (k % 20).cast("int")),
            s("20.", k, "."),
        )
        flags = F.when(
            k % 13 > 0,
            record(
                MATCHES_CONTROL_FIELDS,
                ip=F.when(k % 11 == 0, True),
                http=F.when(k % 2 == 0, True),
                cert=F.when(k % 3 == 1, True),
                asnum=F.when(k % 10 == 3, True),
                asname=F.when(k % 8 == 0, True),
            ),
        )
        return record(
            ANSWER_FIELDS,
            ip=s(start, i, ".9"),
            http=F.when(k % 3 > 0, s("h", k)),
            cert=F.when(k % 4 > 0, s("c", k)),
            matches_control=flags,
            ip_metadata=ip_metadata(
                asn=F.when(k % 5 > 0, k + 1000),
                as_name=F.when(k % 6 > 0, F.when(k % 7 == 0, s("AMAZON-", k)).otherwise(s("NET", k))),
            ),
            http_response=response(
                is_known_blockpage=F.when(k % 15 == 0, True).when(k % 15 < 4, False),
                page_signature=s("fp", k % 4),
                status=s("200 ", k),
            ),
            https_response=response(
                tls_cert_matches_domain=F.when(k % 9 > 2, k % 9 < 6),
                tls_cert_has_trusted_ca=F.when(k % 10 > 2, k % 10 < 7),
                tls_cert_issuer=F.when(k % 12 > 0, s("CA", k % 5)),
                tls_cert_common_name=F.when(k % 14 > 0, s("cn", k)),
                tls_version=F.lit(771),
            ),
            http_error=F.when(k % 16 == 0, s("error ", k)),
        )

    # The kind is worked out once per answer, not in each of the fields it decides.
    places = F.transform(steps(c("n") % 4), lambda i: F.struct(i.alias("i"), ((c("l_suppkey") * 7 + c("l_partkey") + i) % 97).alias("k")))
    answers = F.transform(places, answer)
    null = F.lit(None)
    return base.select(
        "domain", "is_control", "ip", "is_control_ip", c("day").alias("date"),
        F.concat("day", F.lit("T01:02:03.5-04:00")).alias("start_time"),
        F.concat("day", F.lit("T01:02:04.5-04:00")).alias("end_time"),
        (c("n") - 1).alias("retry"), "error", "anomaly", (c("rcode") == 0).alias("success"),
        (c("status") == "F").alias("controls_failed"), c("rcode").cast("bigint").alias("rcode"),
        (c("flag") == "N").alias("has_type_a"), null.cast("double").alias("average_confidence"),
        null.cast("boolean").alias("untagged_controls"), null.cast("boolean").alias("untagged_response"),
        F.lit(False).alias("excluded"), F.lit("before").alias("exclude_reason"),
        answers.alias("received"), ip_metadata(country=F.lit("own")).alias("ip_metadata"),
        "measurement_id", F.lit(0).alias("roundtrip"), "source", *extra,
    )


def table_rows(spark, sf) -> DataFrame:
    """The rows with answers as the DNS table nests them."""
    return dns_rows(spark, sf).withColumn("answers", F.transform("received", table_answer))


OUTCOME_CTES = """g AS (SELECT measurement_id, bool_or(m_ip) AS any_ip, bool_or(matches AND trusted) AS valid,
      bool_or(matches AND NOT trusted) AS bad_ca, bool_and(NOT matches) AS bad_domain, bool_or(blockpage) AS blocked,
      bool_or(m_asnum) AS any_asn, min(CASE WHEN i = 0 THEN k END) AS k0, min(CASE WHEN i = 0 THEN issuer END) AS issuer0,
      min(CASE WHEN i = 0 THEN common_name END) AS cn0, min(CASE WHEN i = 0 THEN fingerprint END) AS fp0 FROM t GROUP BY measurement_id),
    names AS (SELECT measurement_id, string_agg(label, ',' ORDER BY first) AS signature FROM
      (SELECT measurement_id, coalesce(as_name, 'AS' || asn, 'missing_as_info') AS label, min(i) AS first FROM t GROUP BY 1, 2) GROUP BY 1)"""
OUTCOME_CASE = """CASE WHEN error = 'read udp: i/o timeout' THEN '❓dns.timedout'
    WHEN rcode = -1 THEN '❓dns.timedout' WHEN rcode = 3 THEN '❗️dns.error:NXDomain' WHEN rcode = 40 THEN '❗️dns.unknown_rcode:40'
    WHEN k0 IS NULL THEN '❗️ip.empty'
    WHEN k0 % 20 = 0 THEN '❗️ip.invalid:zero' WHEN k0 % 20 = 1 THEN '❗️ip.invalid:local_host' WHEN k0 % 20 < 5 THEN '❗️ip.invalid:local_net'
    WHEN any_ip THEN '✅ip.matchip' WHEN valid THEN '✅tls.validcert' WHEN bad_ca THEN '❗️tls.badca:' || issuer0
    WHEN bad_domain THEN '❗️' || chr(65039) || 'tls.baddomain:' || cn0 WHEN blocked THEN '❗️http.blockpage:' || fp0
    WHEN any_asn THEN '✅ip.matchasn' ELSE '❓tls.connerror:' || signature END"""


@query(
    "dns_outcome",
    ANSWERS_SQL
    + f", {OUTCOME_CTES} SELECT rows.measurement_id, "
    + shown_sql(outcome=OUTCOME_CASE)
    + " FROM rows LEFT JOIN g USING (measurement_id) LEFT JOIN names USING (measurement_id)",
)
def outcomes(spark, sf):
    outcome = dns_outcome(F.col("error"), F.col("rcode"), F.col("answers"))
    return table_rows(spark, sf).select("measurement_id", *shown(outcome=outcome))


@query(
    "answers_signature",
    ANSWERS_SQL
    + """ SELECT rows.measurement_id, coalesce(signature, '') AS signature FROM rows LEFT JOIN
      (SELECT measurement_id, string_agg(label, ',' ORDER BY first) AS signature FROM
        (SELECT measurement_id, coalesce(as_name, 'AS' || asn, 'missing_as_info') AS label, min(i) AS first FROM t GROUP BY 1, 2)
      GROUP BY 1) USING (measurement_id)""",
)
def signature(spark, sf):
    return table_rows(spark, sf).select("measurement_id", answers_signature(F.col("answers")).alias("signature"))


@query(
    "array_logical",
    ANSWERS_SQL
    + ", g AS (SELECT measurement_id, bool_or(matches) AS any_match, bool_and(NOT matches) AS none_match FROM t GROUP BY 1) SELECT measurement_id, "
    + shown_sql("any_match", "none_match")
    + " FROM rows LEFT JOIN g USING (measurement_id)",
)
def logical(spark, sf):
    any_match = any_true(F.col("answers"), lambda a: a["https_tls_cert_matches_domain"])
    none_match = all_true(F.col("answers"), lambda a: ~a["https_tls_cert_matches_domain"])
    return table_rows(spark, sf).select("measurement_id", *shown(any_match=any_match, none_match=none_match))


@query("capable_domains", ANSWERS_SQL + " SELECT DISTINCT domain, source FROM t WHERE matches AND trusted")
def capable(spark, sf):
    return capable_domains(table_rows(spark, sf))


_TAGS = "(CASE WHEN http IS NULL THEN 0 ELSE 1 END + CASE WHEN cert IS NULL THEN 0 ELSE 1 END + CASE WHEN asn IS NULL THEN 0 ELSE 1 END + CASE WHEN as_name IS NULL THEN 0 ELSE 1 END)"
_SHARED = "(CASE WHEN m_http THEN 1 ELSE 0 END + CASE WHEN m_cert THEN 1 ELSE 0 END + CASE WHEN m_asnum THEN 1 ELSE 0 END + CASE WHEN m_asname THEN 1 ELSE 0 END)"
_CONTROL_SQL = f"""control AS (SELECT source, domain, CAST(max(coalesce({_TAGS}, 0)) AS BIGINT) AS control_tags FROM rows
      LEFT JOIN (SELECT DISTINCT measurement_id, i, http, cert, asn, as_name FROM t) last
        ON last.measurement_id = rows.measurement_id AND last.i = rows.n % 4 - 1
      WHERE NOT is_control AND (is_control_ip OR anomaly IS NULL) GROUP BY source, domain)"""
_CONTROL_SQL = _CONTROL_SQL.replace(
    f"coalesce({_TAGS}, 0)", f"CASE WHEN last.measurement_id IS NULL THEN 0 ELSE {_TAGS} END"
)


@query("max_control_tags", ANSWERS_SQL + f", {_CONTROL_SQL} SELECT source, domain, control_tags FROM control")
def control_tags(spark, sf):
    return max_control_tags(dns_rows(spark, sf)).withColumn("control_tags", F.col("control_tags").cast("bigint"))


# Counts of one kind of source only, so that some rows meet no control.
@query(
    "broadcast_control_counts",
    ANSWERS_SQL
    + f""", {_CONTROL_SQL} SELECT measurement_id, CAST(coalesce(control_tags, 0) AS BIGINT) AS control_tags
    FROM rows LEFT JOIN (SELECT * FROM control WHERE source <> 'sat-1') USING (source, domain)""",
)
def control_counts(spark, sf):
    rows = dns_rows(spark, sf)
    counts = max_control_tags(rows).filter(F.col("source") != "sat-1")
    joined = broadcast_control_counts(rows, counts)
    return joined.select("measurement_id", F.col("control_tags").cast("bigint").alias("control_tags"))


_RATED = f"""rated AS (SELECT DISTINCT measurement_id, i, {_TAGS} AS tags, as_name,
    CASE WHEN m_ip THEN 100.0 WHEN {_TAGS} = 0 THEN 0.0 ELSE {_SHARED} * 100.0 / {_TAGS} END AS confidence FROM t),
  summed AS (SELECT measurement_id, avg(confidence) AS average, max(tags) AS most, string_agg(CAST(CAST(round(confidence * 100) AS BIGINT) AS VARCHAR), '|' ORDER BY i) AS each,
    sum(CASE WHEN as_name LIKE 'AMAZON%' THEN 1 ELSE 0 END) AS networks FROM rated GROUP BY measurement_id)"""


def confidence_text() -> Column:
    each = F.transform("received", lambda a: F.round(a["match_confidence"] * 100).cast("bigint").cast("string"))
    return F.array_join(each, "|")


@query(
    "dns_confidence",
    ANSWERS_SQL
    + f", {_RATED} SELECT measurement_id, "
    + rounded_sql("coalesce(average, 0)", "average_confidence")
    + ", "
    + shown_sql(
        each="coalesce(each, '')",
        untagged_controls="n % 2 = 0",
        untagged_response="coalesce(most, 0) = 0",
        anomaly="CASE WHEN coalesce(most, 0) = 0 THEN false ELSE anomaly END",
    )
    + " FROM rows LEFT JOIN summed USING (measurement_id)",
)
def confidence(spark, sf):
    rows = dns_rows(spark, sf).withColumn("control_tags", (F.col("retry") + 1) % 2)
    return dns_confidence(rows).select(
        "measurement_id",
        rounded("average_confidence"),
        *shown("untagged_controls", "untagged_response", "anomaly", each=confidence_text()),
    )


@query(
    "exclude_cdn",
    ANSWERS_SQL
    + f", {_RATED} SELECT measurement_id, "
    + shown_sql(
        excluded="CASE WHEN anomaly THEN coalesce(networks, 0) > 0 END",
        exclude_reason="CASE WHEN anomaly THEN trim(repeat('is_CDN ', CAST(coalesce(networks, 0) AS BIGINT))) END",
    )
    + " FROM rows LEFT JOIN summed USING (measurement_id)",
)
def cdn(spark, sf):
    return exclude_cdn(dns_rows(spark, sf)).select("measurement_id", *shown("excluded", "exclude_reason"))


_IS_TEST = "(NOT is_control AND NOT is_control_ip AND anomaly IS NOT NULL)"


@query(
    "partition_and_rejoin",
    ANSWERS_SQL
    + f""", {_CONTROL_SQL}, {_RATED},
    p AS (SELECT rows.*, {_IS_TEST} AS test, coalesce(control_tags, 0) AS tags, coalesce(average, 0) AS average, coalesce(most, 0) AS most,
      coalesce(each, '') AS each, coalesce(networks, 0) AS networks, anomaly AND coalesce(most, 0) > 0 AS suspect
      FROM rows LEFT JOIN control USING (source, domain) LEFT JOIN summed USING (measurement_id))
    SELECT measurement_id, {rounded_sql("CASE WHEN test THEN average END", "average_confidence")}, """
    + shown_sql(
        each="CASE WHEN test THEN each ELSE '' END",
        untagged_controls="CASE WHEN test THEN tags = 0 END",
        untagged_response="CASE WHEN test THEN most = 0 END",
        anomaly="CASE WHEN test THEN suspect ELSE anomaly END",
        excluded="CASE WHEN test THEN CASE WHEN suspect THEN networks > 0 END ELSE false END",
        exclude_reason="CASE WHEN test THEN CASE WHEN suspect THEN trim(repeat('is_CDN ', CAST(networks AS BIGINT))) END ELSE 'before' END",
    )
    + " FROM p",
)
def processed(spark, sf):
    return postprocess(dns_rows(spark, sf)).select(
        "measurement_id",
        rounded("average_confidence"),
        *shown(
            "untagged_controls", "untagged_response", "anomaly", "excluded", "exclude_reason", each=confidence_text()
        ),
    )


# Tag rows: several per address, some values missing.
ANSWER_TAGS = """SELECT 'sat-' || p_size % 3 AS source, '20.' || p_partkey % 97 || '.' || p_size % 3 || '.9' AS ip,
    CASE WHEN p_partkey % 5 > 0 THEN 'th' || p_partkey END AS http, CASE WHEN p_partkey % 2 > 0 THEN 'tc' || p_partkey END AS cert,
    CASE WHEN p_partkey % 3 > 0 THEN 'tag ' || p_brand END AS as_name, CASE WHEN p_partkey % 4 > 0 THEN p_partkey END AS asn
  FROM {part}"""


def answers_of(rows: DataFrame, **fields: str) -> DataFrame:
    """One record per answer with some of its fields."""
    exploded = explode_once(rows, ["measurement_id"], F.col("received"), "i", "a")
    return exploded.select(
        "measurement_id",
        F.col("i").cast("bigint").alias("i"),
        *shown(**{name: F.col(f"a.{path}") for name, path in fields.items()}),
    )


@query(
    "join_answer_tags",
    ANSWERS_SQL
    + f""", tags AS (SELECT source, ip, max(http) AS t_http, max(cert) AS t_cert, max(as_name) AS t_as_name, max(asn) AS t_asn
      FROM ({ANSWER_TAGS}) GROUP BY source, ip)
    SELECT measurement_id, i, """
    + shown_sql(
        ip="answer_ip", http="coalesce(t_http, http)", cert="coalesce(t_cert, cert)",
        as_name="coalesce(t_as_name, as_name)", asn="coalesce(t_asn, asn)",
    )
    + " FROM t LEFT JOIN tags ON tags.source = t.source AND tags.ip = answer_ip AND day < '2021-06-24'",
)
def answer_tags(spark, sf):
    joined = join_answer_tags(dns_rows(spark, sf), relation(spark, sf, ANSWER_TAGS))
    return answers_of(
        joined, ip="ip", http="http", cert="cert", as_name="ip_metadata.as_name", asn="ip_metadata.asn"
    )


RESOLVER_TAGS = """SELECT 'sat-' || c_custkey % 3 AS source, '9.' || c_custkey % 200 || '.' || (1 + c_custkey % 7) || '.7' AS ip,
    CASE WHEN c_custkey % 2 = 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 > 0 THEN 'N' || c_nationkey END AS country,
    CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 100 AS DOUBLE) / 100 END AS non_zero_rcode_rate,
    CAST(NULL AS DOUBLE) AS private_ip_rate, CAST(NULL AS DOUBLE) AS zero_ip_rate,
    CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey % 50 AS DOUBLE) / 50 END AS connect_error_rate,
    CAST(NULL AS DOUBLE) AS invalid_cert_rate
  FROM {customer}"""


@query(
    "join_resolver_tags",
    f"""WITH rows AS ({ROWS}), tags AS (SELECT source, ip, max(name) AS name, max(country) AS country, max(non_zero_rcode_rate) AS rate,
      max(connect_error_rate) AS errors FROM ({RESOLVER_TAGS}) GROUP BY source, ip)
    SELECT measurement_id, {shown_sql("name", country="coalesce(country, 'own')")}, {rounded_sql("rate", "non_zero_rcode_rate")},
      {rounded_sql("errors", "connect_error_rate")} FROM rows LEFT JOIN tags USING (source, ip)""",
)
def resolver_tags(spark, sf):
    joined = join_resolver_tags(dns_rows(spark, sf), relation(spark, sf, RESOLVER_TAGS))
    flat = joined.select("measurement_id", "ip_metadata.*")
    return flat.select(
        "measurement_id", *shown("name", "country"), rounded("non_zero_rcode_rate"), rounded("connect_error_rate")
    )


# Answer addresses here are numbers spread over the routes.
_NUMBER = "((l_partkey + i) * 2246822519 + 374761393) % 4294967296"


@query(
    "join_answer_ip_metadata",
    ANSWERS_SQL
    + f""", n AS (SELECT measurement_id, i, http, {DAYS.format(flag='flag')} AS date, {_NUMBER} AS number,
        ((({_NUMBER}) >> 24) || '.' || ((({_NUMBER}) >> 16) & 255) || '.' || ((({_NUMBER}) >> 8) & 255) || '.' || (({_NUMBER}) & 255)) AS ip,
        asn AS own_asn, as_name AS own_name FROM t),
    {lookup_sql("SELECT date, ip, number FROM n")}
    SELECT measurement_id, i, """
    + shown_sql(
        "ip", "netblock", "organization", "as_class", "http",
        asn="coalesce(lookup.asn, own_asn)", as_name="coalesce(lookup.as_name, own_name)",
    )
    + " FROM n LEFT JOIN lookup USING (date, ip)",
)
def answer_metadata(spark, sf):
    c = F.col
    rows = dns_rows(spark, sf, "l_partkey").withColumn(
        "date", F.when(c("anomaly"), "2021-01-05").when(~c("anomaly"), "2021-04-25").otherwise("2021-10-20")
    )
    number = lambda i: ((c("l_partkey") + i) * 2246822519 + 374761393) % 4294967296
    rows = rows.withColumn(
        "received", F.transform("received", lambda a, i: a.withField("ip", long_to_ip(number(i))))
    ).drop("l_partkey")
    rows = stage(rows, "answers", compression="zstd")
    keys = stage(answer_ip_keys(rows), "answers")
    let_go(spark)
    joined = join_answer_ip_metadata(rows, lookup_of(spark, sf, keys), staging=None)
    fields = ["netblock", "organization", "as_class", "asn", "as_name"]
    return answers_of(joined, ip="ip", http="http", **{f: f"ip_metadata.{f}" for f in fields})


FETCHES = """SELECT 'site' || o_orderkey % 40 || '.example.com' AS domain, 'sat-' || o_custkey % 3 AS source,
    '20.' || o_orderkey % 97 || '.' || o_custkey % 3 || '.9' AS ip, CAST(CAST(o_orderdate AS DATE) AS STRING) AS start_time,
    CAST(o_orderkey AS STRING) AS end_time, o_orderstatus <> 'F' AS https,
    CASE WHEN o_orderkey % 4 = 0 THEN 'failed ' || o_orderkey END AS error,
    CASE WHEN o_orderkey % 4 > 0 THEN '200 ' || o_orderkey END AS status FROM {orders}"""


@query(
    "join_page_fetches",
    ANSWERS_SQL
    + f""", f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain, source, ip, https ORDER BY start_time, end_time) AS rn FROM ({FETCHES})) WHERE rn = 1)
    SELECT measurement_id, i, """
    + shown_sql(
        ip="answer_ip",
        http_error="coalesce(p.error, CASE WHEN k % 16 = 0 THEN 'error ' || k END)",
        http_status="CASE WHEN p.domain IS NULL THEN '200 ' || k ELSE p.status END",
        https_error="q.error",
        https_status="q.status",
        issuer="CASE WHEN q.domain IS NULL THEN issuer END",
    )
    + """ FROM t LEFT JOIN f p ON p.domain = t.domain AND p.source = t.source AND p.ip = answer_ip AND NOT p.https AND day >= '2021-03-01'
     LEFT JOIN f q ON q.domain = t.domain AND q.source = t.source AND q.ip = answer_ip AND q.https AND day >= '2021-03-01'""",
)
def page_fetches(spark, sf):
    fetches = relation(spark, sf, FETCHES).withColumn("received", response(status=F.col("status"))).drop("status")
    joined = join_page_fetches(dns_rows(spark, sf), fetches)
    return answers_of(
        joined,
        ip="ip",
        http_error="http_error",
        http_status="http_response.status",
        https_error="https_error",
        https_status="https_response.status",
        issuer="https_response.tls_cert_issuer",
    )


@query(
    "flatten_output_schema",
    ANSWERS_SQL
    + "SELECT measurement_id, i, "
    + shown_sql(
        "domain", "source",
        domain_category="'cat'", domain_is_control="is_control", date="day", retry="n - 1",
        start="day || ' 05:02:03'", resolver_ip="ip", resolver_is_trusted="is_control_ip", resolver_country="'own'",
        received_error="error", received_rcode="rcode", domain_controls_failed="status = 'F'",
        answer_ip="answer_ip", answer_asn="asn", answer_as_name="as_name", answer_cert="cert", answer_hash="http",
        same_asn="m_asnum", same_name="m_asname", answer_status="'200 ' || k", tls_version="771",
        issuer="issuer", matches="matches", trusted="trusted", blockpage="blockpage", headers="''",
    )
    + " FROM t",
)
def output_rows(spark, sf):
    c = F.col
    flat = dns_table(dns_rows(spark, sf).withColumn("category", F.lit("cat")))
    exploded = explode_once(flat, ["*"], F.col("answers"), "i", "a")
    return exploded.select(
        "measurement_id",
        c("i").cast("bigint").alias("i"),
        *shown(
            "domain", "source", "domain_category", "domain_is_control", "date", "retry", "resolver_ip",
            "resolver_is_trusted", "resolver_country", "received_error", "received_rcode", "domain_controls_failed",
            start=F.date_format("start_time", "yyyy-MM-dd HH:mm:ss"),
            answer_ip=c("a.ip"), answer_asn=c("a.asn"), answer_as_name=c("a.as_name"),
            answer_cert=c("a.censys_ip_cert"), answer_hash=c("a.censys_http_body_hash"),
            same_asn=c("a.matches_control.asn"), same_name=c("a.matches_control.as_name"),
            answer_status=c("a.http_response_status"), tls_version=c("a.https_tls_version"),
            issuer=c("a.https_tls_cert_issuer"), matches=c("a.https_tls_cert_matches_domain"),
            trusted=c("a.https_tls_cert_has_trusted_ca"), blockpage=c("a.http_analysis_is_known_blockpage"),
            headers=F.array_join("a.http_response_headers", "|"),
        ),
    )


@query(
    "export_projection",
    ANSWERS_SQL
    + "SELECT measurement_id, i, 20 AS columns, 22 AS answer_fields, "
    + shown_sql(
        "domain", resolver_ip="ip", received_error="error", answer_ip="answer_ip", answer_asn="asn",
        http_error="CASE WHEN k % 16 = 0 THEN 'error ' || k END", issuer="issuer",
    )
    + " FROM t",
)
def exported(spark, sf):
    c = F.col
    kept = export_projection(dns_table(dns_rows(spark, sf).withColumn("category", F.lit("cat"))))
    fields = kept.schema["answers"].dataType.elementType.fieldNames()
    exploded = explode_once(kept, ["*"], F.col("answers"), "i", "a")
    return exploded.select(
        "measurement_id",
        c("i").cast("bigint").alias("i"),
        F.lit(len(kept.columns) - 1).alias("columns"),
        F.lit(len(fields)).alias("answer_fields"),
        *shown(
            "domain", "resolver_ip", "received_error", answer_ip=c("a.ip"), answer_asn=c("a.asn"),
            http_error=c("a.http_error"), issuer=c("a.https_tls_cert_issuer"),
        ),
    )




@query(
    "resolver_error_rates",
    ANSWERS_SQL
    + """, failed AS (SELECT rows.measurement_id, source, ip, domain, rcode < 0 AS c, rcode > 0 AS z,
      coalesce((SELECT bool_or(matches IS NOT NULL AND NOT coalesce(matches AND trusted, false)) FROM t WHERE t.measurement_id = rows.measurement_id), false) AS v FROM rows),
    folded AS (SELECT source, ip, domain, bool_or(c) AS c, bool_or(z) AS z, bool_or(v) AS v FROM failed GROUP BY 1, 2, 3)
    SELECT source, ip AS resolver_ip, CAST(count(*) AS BIGINT) AS domains, """
    + ", ".join(rounded_sql(f"avg(CASE WHEN {c} THEN 1.0 ELSE 0.0 END)", f"{n}_rate") for c, n in (("c", "connect_error"), ("v", "invalid_cert"), ("z", "non_zero_rcode")))
    + " FROM folded GROUP BY 1, 2",
)
def error_rates(spark, sf):
    rates = resolver_error_rates(dns_table(dns_rows(spark, sf).withColumn("category", F.lit("cat"))))
    return rates.select("source", "resolver_ip", "domains", *[rounded(f"{k}_rate") for k in RATES])


@query(
    "read_answer_tags",
    f"SELECT source, ip, {shown_sql('http', 'cert', 'as_name', 'asn')} FROM ({ANSWER_TAGS})",
)
def answer_tag_lines(spark, sf):
    tags = relation(spark, sf, ANSWER_TAGS)
    line = F.to_json(F.struct("ip", "http", "cert", F.col("as_name").alias("asname"), F.col("asn").alias("asnum")))
    lines = tags.select(s("d/", F.col("source"), "/tagged_responses.json").alias("file_path"), line.alias("value"))
    bad = tags.select(s("d/x/tagged_responses.json").alias("file_path"), F.expr("left(ip, 4)").alias("value"))
    return read_answer_tags(lines.union(bad)).select("source", "ip", *shown("http", "cert", "as_name", "asn"))
