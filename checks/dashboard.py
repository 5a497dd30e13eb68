"""Base tables to the dashboard table, step by step and as a whole."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.answers import ANSWERS_SQL, OUTCOME_CASE, OUTCOME_CTES, dns_rows, table_rows
from checks.common import MEASUREMENTS, query, relation, shown, shown_sql, table
from checks.flatten import ROUNDTRIPS, probe_v2_lines
from checks.text import PROBE_ERRORS, pick, pick_sql, suffix_rules
from scanlake.functions.labels import mask_control_domain
from scanlake.functions.outcomes import mark_outcome
from scanlake.functions.records import ip_metadata
from scanlake.operators.probe import flatten_probe
from scanlake.operators.reduce import (
    bad_resolver_filter,
    capable_domain_semi_join,
    capable_domains,
    join_country_names,
    keep_last_retry,
    last_retry,
    project_dns_scan,
    project_probe_scan,
    reduce_scans,
    union_scans,
    with_dns_outcome,
)
from scanlake.operators.tables import dns_table
from scanlake.plans.dashboard import build_dashboard
from scanlake.plans.probe_table import add_outcome

# Tries of measurements: an order is a measurement, its line number the try.
TRIES = f"""SELECT SUBSTR(day, 1, 4) AS date, 'm' || l_orderkey AS measurement_id,
    CASE WHEN status = 'O' AND flag = 'N' THEN NULL ELSE n - 1 END AS retry, l_partkey, l_suppkey, cents FROM ({MEASUREMENTS}) m"""


@query(
    "last_retry",
    f"WITH t AS ({TRIES}) SELECT date, measurement_id, coalesce(CAST(max(retry) AS VARCHAR), '~') AS retry FROM t GROUP BY 1, 2",
)
def last(spark, sf):
    return last_retry(relation(spark, sf, TRIES)).select("date", "measurement_id", *shown("retry"))


@query(
    "keep_last_retry",
    f"""WITH t AS ({TRIES}), m AS (SELECT date, measurement_id, max(retry) AS retry FROM t GROUP BY 1, 2)
    SELECT date, t.measurement_id, coalesce(CAST(t.retry AS VARCHAR), '~') AS retry, l_partkey, cents FROM t JOIN m USING (date, measurement_id)
    WHERE t.retry = m.retry OR t.retry IS NULL""",
)
def kept(spark, sf):
    tries = relation(spark, sf, TRIES)
    return keep_last_retry(tries, last_retry(tries)).select(
        "date", "measurement_id", *shown("retry"), "l_partkey", "cents"
    )


@query(
    "probe_outcome_counts",
    ROUNDTRIPS
    + """SELECT SUBSTR(day, 1, 7) AS month, CASE WHEN (l_partkey + i) % 3 = 0 THEN 'CONTROL' ELSE 'test' || l_partkey || '.net' END AS domain,
      CASE flag WHEN 'A' THEN '❔unknown/unknown' WHEN 'N' THEN '✅match' ELSE '❓content/mismatch' END AS outcome,
      CAST(count(*) AS BIGINT) AS count FROM t GROUP BY 1, 2, 3""",
)
def outcome_counts(spark, sf):
    """From raw lines to counts: parse, explode, classify, mark, group."""
    rows = add_outcome(flatten_probe(probe_v2_lines(spark, sf)))
    return (
        rows.select(
            F.substring("date", 1, 7).alias("month"),
            mask_control_domain(F.col("domain"), F.col("is_control")).alias("domain"),
            mark_outcome(F.col("outcome")).alias("outcome"),
        )
        .groupBy("month", "domain", "outcome")
        .agg(F.count("*").alias("count"))
    )


# Rows of other domains than the capable ones: the last two thirds have none.
VISITS = """SELECT o_orderkey, 'site' || o_custkey % 60 || '.example.com' AS domain, 'sat-' || o_orderkey % 4 AS source FROM {orders}"""


@query(
    "capable_domain_semi_join",
    ANSWERS_SQL
    + f""", c AS (SELECT DISTINCT domain, source FROM t WHERE matches AND trusted)
    SELECT o_orderkey, domain, source FROM ({VISITS}) JOIN c USING (domain, source)""",
)
def semi_join(spark, sf):
    return capable_domain_semi_join(relation(spark, sf, VISITS), capable_domains(table_rows(spark, sf)))


RATES = """SELECT l_orderkey, l_partkey, l_linenumber,
    CASE WHEN l_partkey % 4 > 0 THEN CAST(l_suppkey * 13 % 101 AS DOUBLE) / 100 END AS resolver_connect_error_rate,
    CASE WHEN l_partkey % 5 > 0 THEN CAST(l_partkey * 17 % 89 AS DOUBLE) / 100 END AS resolver_invalid_cert_rate,
    CASE WHEN l_partkey % 7 > 0 THEN CAST(l_orderkey * 19 % 97 AS DOUBLE) / 100 END AS resolver_non_zero_rcode_rate
  FROM {lineitem}"""


@query(
    "bad_resolver_filter",
    f"""SELECT l_orderkey, l_partkey, l_linenumber FROM ({RATES}) WHERE resolver_connect_error_rate <= .75
    AND resolver_invalid_cert_rate <= .75 AND resolver_non_zero_rcode_rate <= .75""",
)
def good_resolvers(spark, sf):
    return bad_resolver_filter(relation(spark, sf, RATES)).select("l_orderkey", "l_partkey", "l_linenumber")


# Probe tables: the remainder of the line number tells the scan type.
PROBE_ROWS = f"""SELECT n % 4 AS kind, cents, flag, SUBSTR(day, 1, 7) || '-01' AS date, CASE WHEN l_suppkey % 8 > 0 THEN 'N' || l_suppkey % 30 END AS server_country,
    'AS full ' || l_partkey % 3 AS server_as_full_name, CASE WHEN l_partkey % 3 > 0 THEN l_partkey % 3 END AS server_asn,
    CASE WHEN l_partkey % 2 = 0 THEN 'org' || l_partkey % 4 END AS server_organization,
    'dom' || l_partkey % 6 AS domain, CASE WHEN l_partkey % 5 = 0 THEN true WHEN l_partkey % 5 < 3 THEN false END AS domain_is_control,
    CASE WHEN l_partkey % 6 > 1 THEN 'cat' || l_partkey % 6 END AS domain_category,
    CASE flag WHEN 'R' THEN false WHEN 'A' THEN l_suppkey % 2 = 0 END AS controls_failed FROM ({MEASUREMENTS}) m"""
_OUTCOMES = sorted({o for _, _, o in PROBE_ERRORS} | {"expected/match", "content/blockpage:x"})
KINDS = {0: "DISCARD", 1: "ECHO", 2: "HTTP", 3: "HTTPS"}


def probe_rows(spark, sf):
    rows = relation(spark, sf, PROBE_ROWS).withColumn("outcome", pick(_OUTCOMES, F.col("cents")))
    return rows.withColumn("date", F.col("date").cast("date"))


def probe_tables(spark, sf):
    rows = probe_rows(spark, sf)
    return {label.lower(): rows.filter(F.col("kind") == kind) for kind, label in KINDS.items()}


_MARK = """CASE WHEN o LIKE 'setup/%' OR o LIKE 'unknown/%' OR o LIKE 'dial/%' OR o LIKE 'read/system%' THEN '❔' || o
    WHEN o LIKE 'expected/%' THEN '✅' || substr(o, 10)
    WHEN o LIKE 'content/blockpage%' OR o LIKE 'read/%' OR o LIKE 'write/%' THEN '❗️' || o ELSE '❓' || o END"""
PROBE_SQL = f"""p AS (SELECT *, CASE kind WHEN 0 THEN 'DISCARD' WHEN 1 THEN 'ECHO' WHEN 2 THEN 'HTTP' ELSE 'HTTPS' END AS source, {_MARK} AS outcome
    FROM (SELECT *, {pick_sql(_OUTCOMES, 'cents')} AS o FROM ({PROBE_ROWS})))"""
_LABELS = """CASE WHEN server_asn IS NOT NULL THEN 'AS' || server_asn || coalesce(' - ' || server_organization, '') END AS subnetwork,
    CASE WHEN domain_is_control THEN 'CONTROL' ELSE domain END AS domain, coalesce(domain_category, 'Uncategorized') AS category"""


@query(
    "union_scans",
    ANSWERS_SQL
    + f""", {OUTCOME_CTES}, {PROBE_SQL}
    SELECT source, outcome, coalesce(server_country, '~') AS server_country, CAST(count(*) AS BIGINT) AS measured FROM p GROUP BY 1, 2, 3
    UNION ALL SELECT 'DNS', coalesce(outcome, '~'), 'own', CAST(count(*) AS BIGINT) FROM (SELECT {OUTCOME_CASE} AS outcome
      FROM rows LEFT JOIN g USING (measurement_id) LEFT JOIN names USING (measurement_id)) d GROUP BY 2""",
)
def union(spark, sf):
    scans = [project_probe_scan(rows, kind.upper()) for kind, rows in probe_tables(spark, sf).items()]
    flat = dns_table(dns_rows(spark, sf).withColumn("category", F.lit("c")))
    scans.append(project_dns_scan(with_dns_outcome(flat)))
    whole = union_scans(scans).withColumns({c: F.coalesce(c, F.lit("~")) for c in ("outcome", "server_country")})
    return whole.groupBy("source", "outcome", "server_country").agg(F.count("*").alias("measured"))


@query(
    "reduce_scans",
    f"""WITH {PROBE_SQL}, d AS (SELECT date, source, server_country, server_as_full_name, outcome, {_LABELS} FROM p
      WHERE outcome NOT LIKE '❔setup/%' AND outcome <> '❔read/system')
    SELECT {shown_sql("date", "source", "subnetwork", country_code="server_country", network="server_as_full_name")}, domain, category, outcome,
      CAST(count(*) AS BIGINT) AS count FROM d GROUP BY ALL""",
)
def reduced(spark, sf):
    scans = [project_probe_scan(rows, kind.upper()) for kind, rows in probe_tables(spark, sf).items()]
    return reduce_scans(union_scans(scans)).select(
        *shown("date", "source", "subnetwork", "country_code", "network"), "domain", "category", "outcome", "count"
    )


@query(
    "join_country_names",
    """SELECT c_custkey, coalesce(n_name, 'N' || c_nationkey * 2) AS country_name FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey * 2
    WHERE c_custkey % 6 > 0""",
)
def country_names(spark, sf):
    c = F.col
    rows = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(c("c_custkey") % 6 > 0, F.concat(F.lit("N"), (c("c_nationkey") * 2).cast("string"))).alias("country_code"),
    )
    return join_country_names(rows, nation_codes(spark, sf))


def nation_codes(spark, sf):
    return table(spark, sf, "nation").select(
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("country_code"),
        F.col("n_name").alias("country_name"),
    )


# The whole dashboard: probe rows of passed controls since a date, and DNS rows of
# good resolvers, last tries and capable domains.
EARLIEST = "2020-06-01"
_DNS_SQL = (
    ANSWERS_SQL
    + f""", {OUTCOME_CTES},
    capable AS (SELECT DISTINCT domain, source FROM t WHERE matches AND trusted AND day >= '{EARLIEST}'),
    since AS (SELECT *, SUBSTR(day, 1, 7) || '-01' AS date, 'm' || l_orderkey AS mid, CASE WHEN flag <> 'N' THEN n - 1 END AS retry
      FROM rows WHERE day >= '{EARLIEST}'),
    last AS (SELECT date, mid, max(retry) AS retry FROM since GROUP BY 1, 2),
    outcomes AS (SELECT since.*, {OUTCOME_CASE} AS outcome, CASE WHEN l_suppkey % 6 > 0 THEN l_suppkey % 6 * 15 / 100 END AS rate
      FROM since LEFT JOIN g USING (measurement_id) LEFT JOIN names USING (measurement_id) WHERE status <> 'F')"""
)


@query(
    "dashboard_table",
    _DNS_SQL
    + f""", {PROBE_SQL}, whole AS (
      SELECT date, source, server_country, NULL AS hostname, server_as_full_name AS network, outcome, {_LABELS} FROM p
        WHERE date >= '{EARLIEST}' AND NOT controls_failed AND outcome NOT LIKE '❔setup/%' AND outcome <> '❔read/system'
      UNION ALL SELECT o.date, 'DNS', 'own', CASE WHEN n % 2 = 0 THEN 'special' ELSE 'dns.host' || n || '.co.uk.' END, NULL, outcome, NULL,
        CASE WHEN is_control THEN 'CONTROL' ELSE domain END, 'c' FROM outcomes o JOIN last l ON o.date = l.date AND o.mid = l.mid AND (o.retry = l.retry OR o.retry IS NULL)
        JOIN capable USING (domain, source) WHERE rate <= 0.75 AND outcome IS NOT NULL),
    counted AS (SELECT *, count(*) AS count FROM whole WHERE server_country IS NOT NULL GROUP BY ALL)
    SELECT domain, category, outcome, CAST(count AS BIGINT) AS count, """
    + shown_sql(
        "date", "source", "hostname", "network", "subnetwork",
        reg_hostname="CASE WHEN hostname = 'special' THEN 'special' WHEN hostname LIKE 'dns.host%' THEN rtrim(substr(hostname, 5), '.') END",
        country_name="coalesce(n_name, server_country)",
        unexpected_count="CASE WHEN outcome LIKE '✅%' THEN 0 WHEN outcome LIKE '❔%' THEN NULL ELSE count END",
    )
    + " FROM counted LEFT JOIN nation ON server_country = 'N' || n_nationkey",
)
def dashboard(spark, sf):
    c = F.col
    rows = dns_rows(spark, sf, "l_orderkey", "n", "flag", "l_suppkey")
    hostname = F.when(c("n") % 2 == 0, "special").otherwise(
        F.concat(F.lit("dns.host"), c("n").cast("string"), F.lit(".co.uk."))
    )
    metadata = ip_metadata(
        country=F.lit("own"),
        name=hostname,
        connect_error_rate=F.when(c("l_suppkey") % 6 > 0, c("l_suppkey") % 6 * 15 / 100),
        invalid_cert_rate=F.lit(0.0),
        non_zero_rcode_rate=F.lit(0.5),
    )
    rows = rows.withColumns(
        {
            "date": F.concat(F.substring("date", 1, 7), F.lit("-01")),
            "measurement_id": F.concat(F.lit("m"), c("l_orderkey").cast("string")),
            "retry": F.when(c("flag") != "N", c("n") - 1),
            "ip_metadata": metadata,
            "category": F.lit("c"),
        }
    )
    tables = probe_tables(spark, sf) | {"satellite": dns_table(rows)}
    whole = build_dashboard(tables, nation_codes(spark, sf), suffix_rules(spark), EARLIEST, f"dashboard-{uuid.uuid4().hex}")
    texts = ["date", "source", "hostname", "reg_hostname", "network", "subnetwork", "country_name", "unexpected_count"]
    return whole.select("domain", "category", "outcome", "count", *shown(*texts))
