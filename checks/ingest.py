"""Choosing input files, comparing targets, writing tables and counting."""

from __future__ import annotations

import uuid

from pyspark.sql import Observation, Window
from pyspark.sql import functions as F

from checks.common import MEASUREMENTS, query, relation, shown, shown_sql
from checks.flatten import json_text, s
from checks.networks import ROUTES
from scanlake.functions.paths import between_dates, scan_type_of, source_of
from scanlake.operators.analysis import sample_rows
from scanlake.operators.lines import DeadLetters
from scanlake.operators.probe import flatten_probe
from scanlake.session import shared_folder
from scanlake.sources.files import (
    existing_sources,
    exported_sources,
    new_sources,
    read_lines,
    reconcile_sources,
    select_input_files,
)
from scanlake.sources.reference_data import (
    completeness_check,
    parse_two_section_file,
    read_as_types,
    read_categories,
    read_country_names,
    read_prefix_table,
    read_signatures,
)
from scanlake.sources.publication import Log, read_published
from scanlake.sources.sinks import csv_export, fail_if_empty, observed, write_base_table, write_json_export

# One file per order, of several scan types and names.
FILES = """SELECT o_orderkey, 'store/' || kind || '/' || 'Quack-' || kind || '-' || day || '/' || name AS path,
    'Quack-' || kind || '-' || day AS source, kind, day, name, length
  FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day, o_custkey % 90 AS length,
    CASE o_orderkey % 4 WHEN 0 THEN 'echo' WHEN 1 THEN 'discard' WHEN 2 THEN 'https' ELSE 'http' END AS kind,
    CASE o_custkey % 4 WHEN 0 THEN 'results.json' WHEN 1 THEN 'results.json.gz' WHEN 2 THEN 'resolvers.json' ELSE 'readme.txt' END AS name
    FROM {orders}) files"""
# Sources that are loaded already: of finished orders.
LOADED = f"SELECT source FROM ({FILES.replace('FROM {orders}', 'FROM {orders} WHERE o_orderstatus = ' + chr(39) + 'F' + chr(39))}) loaded"
EXPORTED = LOADED.replace("'F'", "'P'")


@query(
    "select_input_files",
    f"""SELECT path, length FROM ({FILES}) WHERE day BETWEEN '1996-02-01' AND '1998-11-30' AND name LIKE 'results.json%' AND length > 33
    AND source NOT IN ({LOADED})""",
)
def chosen(spark, sf):
    files = relation(spark, sf, FILES).select("path", "length")
    return select_input_files(files, "http", "1996-02-01", "1998-11-30", relation(spark, sf, LOADED))


@query(
    "between_dates",
    """SELECT event_id, event_id % 6 > 0 AND day BETWEEN '2024-01-05' AND '2024-01-20' AS inside,
      event_id % 6 > 0 AND day >= '2024-01-05' AS later, event_id % 6 > 0 AND day <= '2024-01-20' AS earlier, event_id % 6 > 0 AS dated
    FROM (SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events)""",
)
def dates(spark, sf):
    day = F.to_date("ts").cast("string")
    path = F.when(F.col("event_id") % 6 == 0, "store/undated/results.json").otherwise(
        s("store/Quack-echo-", day, "-06-01/2024-13-99.json")
    )
    return relation(spark, sf, "SELECT * FROM {events}").select(
        "event_id",
        between_dates(path, "2024-01-05", "2024-01-20").alias("inside"),
        between_dates(path, start="2024-01-05").alias("later"),
        between_dates(path, end="2024-01-20").alias("earlier"),
        between_dates(path).alias("dated"),
    )


@query("source_from_path", f"SELECT o_orderkey, source, kind AS scan_type FROM ({FILES})")
def sources(spark, sf):
    files = relation(spark, sf, FILES).select("o_orderkey", source_of(F.col("path")).alias("source"))
    return files.withColumn("scan_type", scan_type_of(F.col("source")))


@query(
    "existing_sources",
    f"SELECT 'table' AS target, source FROM (SELECT DISTINCT source FROM ({LOADED})) UNION ALL SELECT 'export', source FROM (SELECT DISTINCT source FROM ({EXPORTED}))",
)
def existing(spark, sf):
    files = relation(spark, sf, EXPORTED).select(
        s("out/source=", F.col("source"), "/country=X/results.json.gz").alias("path")
    )
    other = files.select(F.regexp_replace("path", "/source=", "/notes-").alias("path"))
    table = existing_sources(relation(spark, sf, LOADED)).select(F.lit("table").alias("target"), "source")
    return table.union(exported_sources(files.union(other)).select(F.lit("export"), "source"))


@query("incremental_new_sources", f"SELECT path FROM ({FILES}) WHERE source NOT IN ({LOADED})")
def incremental(spark, sf):
    return new_sources(relation(spark, sf, FILES).select("path"), relation(spark, sf, LOADED))


@query(
    "reconcile_sources",
    f"""SELECT source, 'export' AS missing_in FROM (SELECT source FROM ({LOADED}) EXCEPT SELECT source FROM ({EXPORTED}))
    UNION ALL SELECT source, 'table' FROM (SELECT source FROM ({EXPORTED}) EXCEPT SELECT source FROM ({LOADED}))""",
)
def reconciled(spark, sf):
    return reconcile_sources(relation(spark, sf, LOADED), relation(spark, sf, EXPORTED))


@query(
    "completeness_check",
    """WITH found AS (SELECT l_shipdate AS day, count(DISTINCT l_orderkey) AS found FROM lineitem GROUP BY 1),
    expected AS (SELECT o_orderdate AS day, count(*) AS expected FROM orders GROUP BY 1)
    SELECT CAST(CAST(day AS DATE) AS VARCHAR) AS source, CAST(expected AS BIGINT) AS expected, CAST(coalesce(found, 0) AS BIGINT) AS found,
      expected = coalesce(found, 0) AS complete FROM expected LEFT JOIN found USING (day)""",
)
def complete(spark, sf):
    measured = relation(
        spark, sf, "SELECT CAST(CAST(l_shipdate AS DATE) AS STRING) AS source, l_orderkey AS measurement_id FROM {lineitem}"
    )
    expected = relation(
        spark, sf, "SELECT CAST(CAST(o_orderdate AS DATE) AS STRING) AS source, count(*) AS count FROM {orders} GROUP BY 1"
    )
    return completeness_check(measured, expected)


@query(
    "parse_two_section_file",
    "SELECT s_suppkey AS asn, "
    + shown_sql(as_name="s_name", as_full_name="n_name", country="CASE WHEN n_name IS NOT NULL THEN 'R' || n_regionkey END")
    + " FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey * 2",
)
def two_sections(spark, sf):
    orgs = relation(
        spark, sf,
        "SELECT 'ORG' || n_nationkey || '|20120130|' || n_name || '|R' || n_regionkey || '|RIPE' AS value FROM {nation}",
    )
    numbers = relation(
        spark, sf,
        "SELECT s_suppkey || '|20120224|' || s_name || '|ORG' || s_nationkey * 2 || '|e5e3|ARIN' AS value FROM {supplier}",
    )
    comments = relation(spark, sf, "SELECT '# format:' || r_name || '|a|b|c|d' AS value FROM {region}")
    parsed = parse_two_section_file(comments.union(orgs).union(numbers))
    return parsed.select("asn", *shown("as_name", "as_full_name", "country"))


# Line items as rows of a probe table.
TABLE = f"""SELECT CAST(SUBSTR(day, 1, 7) || '-01' AS DATE) AS date, 'C' || l_suppkey % 9 AS server_country, l_partkey % 50 AS server_asn,
    'Quack-http-' || SUBSTR(day, 1, 7) AS source, 'd' || l_partkey AS domain, l_orderkey AS measurement_id
  FROM ({MEASUREMENTS}) m"""


def fresh_path(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    "write_base_table",
    f"""SELECT CAST(date AS VARCHAR) AS date, server_country, CAST(count(*) AS BIGINT) AS measured, CAST(sum(server_asn) AS BIGINT) AS numbers
    FROM ({TABLE}) GROUP BY 1, 2""",
)
def written(spark, sf):
    path = fresh_path(spark, "base")
    write_base_table(relation(spark, sf, TABLE), path)
    return (
        spark.read.parquet(path)
        .groupBy(F.col("date").cast("string").alias("date"), "server_country")
        .agg(F.count("*").alias("measured"), F.sum("server_asn").alias("numbers"))
    )


@query(
    "fail_if_empty",
    f"""SELECT source, CAST(count(*) AS BIGINT) AS measured, (SELECT CAST(count(*) AS BIGINT) FROM lineitem) AS written
    FROM ({TABLE}) GROUP BY source""",
)
def guarded(spark, sf):
    path = fresh_path(spark, "guarded")
    rows = fail_if_empty(relation(spark, sf, TABLE), path)
    return spark.read.parquet(path).groupBy("source").agg(
        F.count("*").alias("measured"), F.lit(rows).cast("bigint").alias("written")
    )


@query(
    "ingest_counters",
    """SELECT CAST(count(*) AS BIGINT) AS lines, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS malformed,
      CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE user_id % 3 END) AS BIGINT) AS flattened FROM events""",
)
def counters(spark, sf):
    """Counted while the rows are written, without a second pass or parse."""
    c = F.col
    trip = json_text(matches_template=F.lit(True), start_time=s(F.to_date("ts")), end_time=s(F.to_date("ts")))
    top = json_text(vp=s("1.2.3.", c("user_id") % 256), test_url=c("event_type"), anomaly=F.lit(False))
    trips = F.array_join(F.array_repeat(trip, (c("user_id") % 3).cast("int")), ",")
    text = F.concat(F.expr("left(top, length(top) - 1)"), F.lit(',"response":['), c("trips"), F.lit("]}"))
    events = relation(spark, sf, "SELECT * FROM {events}")
    lines = events.withColumns({"top": top, "trips": trips}).select(
        s("d/Quack-http-2022-01-01/results.json").alias("file_path"),
        F.when(c("event_type") == "error", F.expr("left(top, 9)")).otherwise(text).alias("value"),
    )
    line_counts = Observation()
    rows, row_counts = observed(flatten_probe(lines, line_counts), F.count("*").alias("flattened"))
    rows.write.parquet(fresh_path(spark, "counted"))
    counts = line_counts.get | row_counts.get
    return spark.range(1).select(*[F.lit(counts[k]).cast("bigint").alias(k) for k in ("lines", "malformed", "flattened")])


# Side files with repeated keys, written in the order of the parts: the last line of a key counts.
SIDE = """SELECT p_partkey, 'dom' || p_partkey % 70 AS domain, p_partkey % 90 AS asn, 'kind ' || p_brand AS label FROM {part}"""


def side_file(spark, sf, name: str, *columns, sep: str = ",") -> str:
    """A file of several parts whose names follow the order of their lines."""
    path = fresh_path(spark, name)
    relation(spark, sf, SIDE).orderBy("p_partkey").select(*columns).write.option("sep", sep).csv(path)
    return path


@query("read_categories", "SELECT 'dom' || p_partkey % 70 AS domain, arg_max('kind ' || p_brand, p_partkey) AS category FROM part GROUP BY 1")
def categories(spark, sf):
    return read_categories(spark, side_file(spark, sf, "categories", "domain", "label"))


@query("read_as_types", "SELECT p_partkey % 90 AS asn, arg_max('kind ' || p_brand, p_partkey) AS as_class FROM part GROUP BY 1")
def as_types(spark, sf):
    return read_as_types(spark, side_file(spark, sf, "types", "asn", F.lit("origin"), "label", sep="|"))


@query(
    "read_country_names",
    "SELECT 'dom' || p_partkey % 70 AS country_code, arg_max('kind ' || p_brand || ', of ' || p_partkey, p_partkey) AS country_name FROM part GROUP BY 1",
)
def country_list(spark, sf):
    name = s(F.col("label"), ", of ", F.col("p_partkey"))
    return read_country_names(spark, side_file(spark, sf, "countries", name, "domain"))


# Lines of events, some of them no measurement in one of several ways.
BROKEN = """SELECT event_id, CASE event_id % 11 WHEN 0 THEN 'cut off' WHEN 1 THEN 'no JSON' WHEN 2 THEN 'no object' WHEN 3 THEN 'a field of another type'
    ELSE 'good' END AS kind FROM {events}"""


@query("dead_letters", f"SELECT file_path, reason, CAST(count(*) AS BIGINT) AS lines FROM (SELECT 'd/Quack-http-2022-01-0' || (1 + event_id % 3) || '/results.json' AS file_path, kind AS reason FROM ({BROKEN})) WHERE reason <> 'good' GROUP BY 1, 2")
def kept_bad_lines(spark, sf):
    """Two sinks from one parse: rows, and the lines that gave none."""
    c = F.col
    good = json_text(vp=s("1.2.3.", c("event_id") % 256), test_url=s("u", c("event_id")), anomaly=F.lit(False))
    value = (
        F.when(c("kind") == "cut off", F.expr("left(good, 12)"))
        .when(c("kind") == "no JSON", F.replace("good", F.lit(chr(34) + "vp" + chr(34) + ":"), F.lit("vp ")))
        .when(c("kind") == "no object", s('"text ', c("event_id"), '"'))
        .when(c("kind") == "a field of another type", F.replace("good", F.lit('"anomaly":false'), F.lit('"anomaly":[1]')))
        .otherwise(good)
    )
    events = relation(spark, sf, BROKEN).withColumn("good", good)
    lines = events.select(s("d/Quack-http-2022-01-0", 1 + c("event_id") % 3, "/results.json").alias("file_path"), value.alias("value"))
    dead = DeadLetters(fresh_path(spark, "dead"), "dead-letters")
    flatten_probe(lines, dead=dead)
    return spark.read.parquet(dead.path).groupBy("file_path", "reason").agg(F.count("*").alias("lines"))


@query(
    "cluster_base_table",
    f"SELECT CAST(date AS VARCHAR) AS date, CAST(count(*) AS BIGINT) AS measured, true AS ordered FROM ({TABLE}) GROUP BY 1",
)
def clustered(spark, sf):
    """Files of a day follow each other by country: each begins where the one before ends or later."""
    path = fresh_path(spark, "clustered")
    write_base_table(relation(spark, sf, TABLE), path, partitions=40)
    files = spark.read.parquet(path).groupBy("date", F.col("_metadata.file_path").alias("file")).agg(
        F.count("*").alias("n"), F.min("server_country").alias("low"), F.max("server_country").alias("high")
    )
    before = F.lag("high").over(Window.partitionBy("date").orderBy("low", "high"))
    marked = files.withColumn("fits", F.coalesce(F.col("low") >= before, F.lit(True)))
    return marked.groupBy(F.col("date").cast("string").alias("date")).agg(F.sum("n").alias("measured"), F.min("fits").alias("ordered"))


@query("scan_lines", "SELECT source, value FROM (SELECT 'part' || r_regionkey AS source, n_name || '|' || n_nationkey AS value FROM nation JOIN region ON r_regionkey = n_regionkey UNION ALL SELECT 'whole', c_name FROM customer)")
def gzip_and_plain_lines(spark, sf):
    """Lines of gzip and plain files of several folders, with the folder they came from."""
    path = fresh_path(spark, "lines")
    nations = relation(spark, sf, "SELECT 'part' || n_regionkey AS source, n_name || '|' || n_nationkey AS value FROM {nation}")
    nations.write.partitionBy("source").option("compression", "gzip").text(path + "/gz")
    empty = relation(spark, sf, "SELECT CASE WHEN c_custkey % 5 = 0 THEN '' ELSE c_name END AS value FROM {customer}")
    filled = relation(spark, sf, "SELECT c_name AS value FROM {customer} WHERE c_custkey % 5 = 0")
    empty.union(filled).write.text(path + "/plain")
    lines = read_lines(spark, [path + "/gz", path + "/plain"])
    source = F.coalesce(F.nullif(F.regexp_extract("file_path", "source=([^/]*)", 1), F.lit("")), F.lit("whole"))
    return lines.select(source.alias("source"), "value")


@query(
    "read_prefix_table",
    f"SELECT '2021-0' || (1 + asn % 9) || '-15' AS snapshot, network, len, asn FROM ({ROUTES.replace('{part}', 'part')})",
)
def route_files(spark, sf):
    path = fresh_path(spark, "routes")
    routes = relation(spark, sf, ROUTES)
    origin = F.when(F.col("asn") % 3 == 0, F.concat_ws("_", F.col("asn"), F.lit(7))).otherwise(F.col("asn").cast("string"))
    folder = s("routeviews-rv2-20210", 1 + F.col("asn") % 9, "15-1200.pfx2as")
    routes.select(folder.alias("snapshot"), "network", "len", origin.alias("origin")).write.partitionBy("snapshot").option("sep", "\t").csv(path)
    found = []
    for month in range(1, 10):  # as files of their own names
        rows = spark.read.csv(f"{path}/snapshot=routeviews-rv2-20210{month}15-1200.pfx2as", sep="\t", schema="network STRING, len INT, origin STRING")
        rows.coalesce(1).write.option("sep", "\t").csv(f"{path}-files/{month}")
        found.append(named_as(spark, f"{path}-files/{month}", f"{path}-named/routeviews-rv2-20210{month}15-1200.pfx2as"))
    return read_prefix_table(spark, found).select(F.col("snapshot").cast("string").alias("snapshot"), "network", "len", "asn")


def named_as(spark, folder: str, path: str) -> str:
    """Give the one file of a written folder a name."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    (part,) = [f.getPath() for f in files.listStatus(hadoop.Path(folder)) if f.getPath().getName().startswith("part-")]
    files.mkdirs(hadoop.Path(path).getParent())
    files.rename(part, hadoop.Path(path))
    return path


@query("read_signatures", "SELECT 'f' || p_partkey % 40 AS fingerprint, arg_max('size ' || p_size || ', brand ' || p_brand, p_partkey) AS pattern FROM part GROUP BY 1")
def signature_file(spark, sf):
    """A repeated fingerprint takes the later pattern."""
    lines = relation(spark, sf, "SELECT p_partkey, 'size ' || p_size || ', brand ' || p_brand AS pattern, 'f' || p_partkey % 40 AS fingerprint FROM {part}")
    path = fresh_path(spark, "signatures")
    lines.orderBy("p_partkey").select(F.to_json(F.struct("pattern", "fingerprint"))).write.text(path)  # files in order
    found = read_signatures(spark, path)
    return spark.createDataFrame(found, "pattern STRING, fingerprint STRING").select("fingerprint", "pattern")


EXPORTED_ROWS = f"SELECT *, CASE WHEN server_asn % 7 > 0 THEN server_country END AS country FROM ({TABLE}) rows"


@query(
    "write_json_export",
    f"""SELECT source, coalesce(country, 'None') AS folder, CAST(count(*) AS BIGINT) AS records, CAST(sum(server_asn) AS BIGINT) AS numbers
    FROM ({EXPORTED_ROWS}) GROUP BY 1, 2""",
)
def json_export(spark, sf):
    """Exported twice, as a repeated load does; records carry the country their folder has."""
    path = fresh_path(spark, "export")
    rows = relation(spark, sf, EXPORTED_ROWS).withColumn("server_country", F.col("country")).drop("country")
    for _ in range(2):
        write_json_export(rows, path)
    back = spark.read.schema("source STRING, server_country STRING, server_asn BIGINT, __file STRING").json(path)
    place = F.col("_metadata.file_path")
    named = back.select(
        F.regexp_extract(place, "source=([^/]*)/", 1).alias("folder_source"), F.regexp_extract(place, "country=([^/]*)/", 1).alias("folder"), F.col("server_country"), "server_asn"
    )
    same = named.where(F.coalesce("server_country", F.lit("None")) == F.col("folder"))
    return same.groupBy(F.col("folder_source").alias("source"), "folder").agg(F.count("*").alias("records"), F.sum("server_asn").alias("numbers"))


@query("csv_export", "SELECT s_suppkey, s_name, coalesce(CAST(CASE WHEN s_suppkey % 3 > 0 THEN s_nationkey END AS VARCHAR), '~') AS nation FROM supplier")
def csv_files(spark, sf):
    path = fresh_path(spark, "csv")
    csv_export(relation(spark, sf, "SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 3 > 0 THEN s_nationkey END AS nation FROM {supplier}"), path)
    back = spark.read.csv(path, header=True, schema="s_suppkey BIGINT, s_name STRING, nation INT")
    return back.select("s_suppkey", "s_name", *shown("nation"))


@query("sample_rows", "SELECT 25 AS drawn, true AS from_the_table FROM region WHERE r_regionkey = 0")
def sampled(spark, sf):
    """Which rows a sample holds is open; how many, and that they are rows of the table, is not."""
    rows = relation(spark, sf, "SELECT l_orderkey, l_linenumber FROM {lineitem}")
    drawn = sample_rows(rows, 25).withColumn("drawn", F.lit(1))
    met = drawn.join(rows.distinct(), ["l_orderkey", "l_linenumber"], "left_semi")
    return met.agg(F.count("*").cast("int").alias("drawn"), F.lit(True).alias("from_the_table"))


@query(
    "publish_load",
    f"""SELECT source, CAST(count(*) AS BIGINT) AS in_table, CAST(count(*) AS BIGINT) AS in_export FROM ({TABLE}) GROUP BY 1""",
)
def published(spark, sf):
    """A load that failed between table and export is finished by the next run, once."""
    table, export = fresh_path(spark, "published"), fresh_path(spark, "export")
    log = Log(spark, table)
    rows = relation(spark, sf, TABLE)
    load = log.stage(rows, sorted(r[0] for r in rows.select("source").distinct().collect()), export)
    write_base_table(rows.limit(10), f"{table}/load={load.number}")  # as if a first try had ended here
    assert read_published(spark, table) is None
    assert [done.number for done in log.finish()] == [load.number] and log.finish() == []
    in_table = read_published(spark, table).groupBy("source").agg(F.count("*").alias("in_table"))
    in_export = spark.read.schema("server_asn BIGINT").json(export).groupBy("source").agg(F.count("*").alias("in_export"))
    return in_table.join(in_export, "source")
