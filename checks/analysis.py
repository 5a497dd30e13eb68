"""Ratios of measurement results per domain, source and day."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import query, relation, rounded, rounded_sql
from scanlake.functions.labels import label_result
from scanlake.operators.analysis import (
    all_under_threshold,
    any_over_threshold,
    daily_ratios,
    log_normalize,
    lowest_success,
    pivot_domain_date,
    pivot_success,
    result_counts,
    success_interference_ratios,
    top_networks,
    with_label,
)

# Own result texts, by label.
SUCCESS = ["HTTP: as expected", "HTTPS: as expected", "ECHO: as expected", "DISCARD: as expected"]
INTERFERENCE = [
    "HTTP: no header within 30 s",
    "ECHO: other bytes came back",
    "DISCARD: bytes where none are due",
]
SYSTEM_ERROR = ["HTTP: closed by the probe", "HTTPS: closed by the probe"]

# Events as analysed rows: the type decides the result text.
ROWS = """SELECT event_id, 'd' || user_id % 10 AS domain,
    CASE user_id % 3 WHEN 0 THEN 'HTTP' WHEN 1 THEN 'HTTPS' ELSE 'ECHO' END AS source,
    CAST(CAST(ts AS DATE) AS STRING) AS date, user_id % 15 AS asn, 'AS name ' || user_id % 15 AS as_name,
    CAST(FLOOR(value) AS BIGINT) + 1 AS count,
    CASE event_type WHEN 'view' THEN 'HTTP: as expected' WHEN 'click' THEN 'ECHO: as expected' WHEN 'signup' THEN 'ECHO: other bytes came back'
      WHEN 'error' THEN CASE WHEN user_id % 2 = 0 THEN 'HTTPS: closed by the probe' ELSE 'DISCARD: bytes where none are due' END
      ELSE 'something else' END AS result
  FROM {events}"""
LABELLED = f"""SELECT *, CASE result WHEN 'HTTP: as expected' THEN 'success' WHEN 'ECHO: as expected' THEN 'success'
    WHEN 'ECHO: other bytes came back' THEN 'interference' WHEN 'DISCARD: bytes where none are due' THEN 'interference'
    WHEN 'HTTPS: closed by the probe' THEN 'system_error' ELSE 'unknown' END AS result_type FROM ({ROWS}) source_rows"""


def ratios_sql(by: str) -> str:
    return f"""SELECT {by}, CAST(coalesce(sum(count) FILTER (result_type = 'success'), 0) AS BIGINT) AS success_count,
      CAST(coalesce(sum(count) FILTER (result_type = 'interference'), 0) AS BIGINT) AS interference_count,
      CAST(sum(count) AS BIGINT) AS total_count,
      coalesce(sum(count) FILTER (result_type = 'success'), 0) / sum(count) AS success_ratio,
      coalesce(sum(count) FILTER (result_type = 'interference'), 0) / sum(count) AS interference_ratio
    FROM ({LABELLED}) WHERE result_type IN ('success', 'interference') GROUP BY {by}"""


DAILY_SQL = f"WITH daily AS ({ratios_sql('date, domain, source')}) "
def rows(spark, sf):
    found = relation(spark, sf, ROWS)
    return with_label(found, label_result(F.col("result"), SUCCESS, INTERFERENCE, SYSTEM_ERROR))


def rounded_ratios(frame, *by):
    counts = ["success_count", "interference_count", "total_count"]
    return frame.select(*by, *counts, rounded("success_ratio"), rounded("interference_ratio"))


def rounded_ratios_sql(source: str, by: str) -> str:
    ratios = ", ".join(rounded_sql(r, r) for r in ("success_ratio", "interference_ratio"))
    return f"SELECT {by}, success_count, interference_count, total_count, {ratios} FROM {source}"


@query("label_results", f"SELECT event_id, result_type FROM ({LABELLED})")
def labels(spark, sf):
    return rows(spark, sf).select("event_id", "result_type")


@query(
    "result_counts_by_domain",
    f"SELECT domain, source, result_type, CAST(sum(count) AS BIGINT) AS count FROM ({LABELLED}) GROUP BY ALL",
)
def counts(spark, sf):
    return result_counts(rows(spark, sf))


@query("success_interference_ratios", rounded_ratios_sql(f"({ratios_sql('domain, source')})", "domain, source"))
def ratios(spark, sf):
    return rounded_ratios(success_interference_ratios(rows(spark, sf)), "domain", "source")


@query("daily_ratios", DAILY_SQL + rounded_ratios_sql("daily", "date, domain, source"))
def daily(spark, sf):
    return rounded_ratios(daily_ratios(rows(spark, sf)), "date", "domain", "source")


@query(
    "pivot_success",
    DAILY_SQL
    + "SELECT date, "
    + ", ".join(rounded_sql(f"max(success_ratio) FILTER (source = '{s}')", s) for s in ("HTTP", "HTTPS", "ECHO"))
    + " FROM daily WHERE domain = 'd3' GROUP BY date",
)
def success_pivot(spark, sf):
    sources = ["HTTP", "HTTPS", "ECHO"]
    wide = pivot_success(daily_ratios(rows(spark, sf)), "d3", sources)
    return wide.select("date", *[rounded(s) for s in sources])


@query(
    "pivot_domain_date",
    DAILY_SQL
    + """SELECT domain, CAST(rank AS INTEGER) AS day, round(coalesce(ratio, -1.0), 6) AS ratio
    FROM (SELECT domain FROM daily WHERE source = 'HTTPS' GROUP BY domain)
    CROSS JOIN (SELECT date, row_number() OVER (ORDER BY date) AS rank FROM daily WHERE source = 'HTTPS' GROUP BY date)
    LEFT JOIN (SELECT domain, date, max(interference_ratio) AS ratio FROM daily WHERE source = 'HTTPS' GROUP BY ALL) USING (domain, date)""",
)
def domain_pivot(spark, sf):
    """Every day of the data is a column; they are shown one below the other, as their number may vary."""
    https = daily_ratios(rows(spark, sf)).filter(F.col("source") == "HTTPS")
    days = sorted(r["date"] for r in https.select("date").distinct().collect())  # column names of the pivot
    wide = pivot_domain_date(https, "interference_ratio", days)
    cells = [F.struct(F.lit(i).alias("day"), F.round(F.coalesce(F.col(f"`{d}`"), F.lit(-1.0)), 6).alias("ratio")) for i, d in enumerate(days, 1)]
    return wide.select("domain", F.explode(F.array(*cells)).alias("cell")).select("domain", "cell.day", "cell.ratio")


@query(
    "any_over_threshold",
    DAILY_SQL + "SELECT domain FROM daily WHERE source = 'HTTPS' GROUP BY domain HAVING bool_or(interference_ratio > 0.95)",
)
def over(spark, sf):
    https = daily_ratios(rows(spark, sf)).filter(F.col("source") == "HTTPS")
    return any_over_threshold(https, 0.95)


@query(
    "all_under_threshold",
    DAILY_SQL
    + """SELECT domain FROM daily WHERE source = 'HTTPS' GROUP BY domain
    HAVING bool_and(interference_ratio < 0.97) AND count(DISTINCT date) = (SELECT count(DISTINCT date) FROM daily WHERE source = 'HTTPS')""",
)
def under(spark, sf):
    https = daily_ratios(rows(spark, sf)).filter(F.col("source") == "HTTPS")
    return all_under_threshold(https, 0.97)


@query(
    "log_normalize",
    DAILY_SQL
    + """, m AS (SELECT max(ln(total_count)) AS top FROM daily)
    SELECT date, domain, source, round((ln(total_count) + 0.05 * top) / (top + 0.05 * top), 6) AS opacity FROM daily, m""",
)
def normalized(spark, sf):
    scaled = log_normalize(daily_ratios(rows(spark, sf)), "total_count", "opacity")
    return scaled.select("date", "domain", "source", rounded("opacity"))


@query(
    "top_networks",
    f"SELECT asn, as_name, CAST(sum(count) AS BIGINT) AS count FROM ({ROWS}) GROUP BY asn, as_name ORDER BY count DESC, asn, as_name LIMIT 5",
)
def networks(spark, sf):
    return top_networks(rows(spark, sf))


@query(
    "lowest_success",
    f"SELECT * FROM ({rounded_ratios_sql('(' + ratios_sql('domain, source') + ')', 'domain, source')}) ORDER BY success_ratio, domain, source LIMIT 20",
)
def lowest(spark, sf):
    return rounded_ratios(lowest_success(success_interference_ratios(rows(spark, sf))), "domain", "source")
