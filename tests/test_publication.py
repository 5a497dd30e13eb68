"""Loads that fail between their steps, and lines that are no measurement."""

import threading

import pytest
from pyspark.sql import functions as F

from scanlake.operators.lines import DeadLetters, skip_malformed
from scanlake.operators.resolvers import fill_error_rates
from scanlake.schemas import PROBE_LINE
from scanlake.session import shared_folder
from scanlake.sources import publication
from scanlake.sources.publication import Log, published_sources, read_published
from scanlake.sources.sinks import EmptyResult, fail_if_empty, stage, write_base_table

SCHEMA = "date STRING, source STRING, server_country STRING, server_asn BIGINT, domain STRING"


def rows_of(spark, source, n=20):
    return spark.createDataFrame([(f"2022-01-0{1 + i % 3}", source, f"C{i % 5}" if i % 7 else None, i, "d.com") for i in range(n)], SCHEMA)


def contents(spark, table, export):
    rows = read_published(spark, table)
    exported = spark.read.schema("source STRING, server_asn BIGINT").json(export)
    return sorted(map(tuple, rows.select("source", "server_asn").collect())), sorted(map(tuple, exported.select("source", "server_asn").collect()))


@pytest.mark.parametrize("failing", ["write_base_table", "write_json_export", "_create"])
def test_a_failed_load_is_finished_once(spark, tmp_path, monkeypatch, failing):
    clean, broken = (str(tmp_path / n) for n in ("clean", "broken"))
    for table in (clean, broken):
        log = Log(spark, table)
        log.publish(log.stage(rows_of(spark, "first"), ["first"], table + "_out"))
    log = Log(spark, clean)
    log.publish(log.stage(rows_of(spark, "second", 33), ["second"], clean + "_out"))

    log = Log(spark, broken)
    load = log.stage(rows_of(spark, "second", 33), ["second"], broken + "_out")

    def fail(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        if failing == "_create":
            patch.setattr(Log, failing, fail)
        else:
            patch.setattr(publication, failing, fail)
        with pytest.raises(RuntimeError, match="lost"):
            log.publish(load)
    # Neither the table nor the sources show a load that is not in both.
    assert {r.source for r in read_published(spark, broken).collect()} == {"first"}
    assert [r.source for r in published_sources(spark, broken).collect()] == ["first"]
    again = Log(spark, broken)
    assert [done.sources for done in again.finish()] == [["second"]] and again.finish() == []
    assert contents(spark, broken, broken + "_out") == contents(spark, clean, clean + "_out")


def test_nothing_stays_of_an_empty_load(spark, tmp_path):
    log = Log(spark, str(tmp_path / "t"))
    with pytest.raises(EmptyResult):
        log.stage(rows_of(spark, "s", 0), ["s"])
    assert log.loads(True) == log.loads(False) == [] and read_published(spark, str(tmp_path / "t")) is None


def test_two_loads_at_once(spark, tmp_path):
    """Each has its own staged rows: neither removes the other's."""
    done, errors = {}, []

    def load(name):
        try:
            for i in range(3):
                done[name, i] = fail_if_empty(rows_of(spark, name, 50 + i), str(tmp_path / f"{name}{i}"))
        except Exception as error:  # noqa: BLE001
            errors.append(error)

    threads = [threading.Thread(target=load, args=(n,)) for n in ("a", "b")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and done == {(n, i): 50 + i for n in "ab" for i in range(3)}


def test_files_of_a_day_follow_each_other(spark, tmp_path):
    rows = spark.range(4000).select(F.lit("2022-01-01").alias("date"), F.format_string("C%02d", F.col("id") % 37).alias("server_country"), (F.col("id") % 91).alias("server_asn"))
    write_base_table(stage(rows, "cluster"), str(tmp_path / "t"), partitions=6)
    files = spark.read.parquet(str(tmp_path / "t")).groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min("server_country").alias("low"), F.max("server_country").alias("high"))
    found = sorted((r.low, r.high) for r in files.collect())
    assert len(found) > 3 and all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_bad_lines_are_kept_and_every_line_is_parsed_once(spark, tmp_path, monkeypatch):
    values = ['{"vp": "1.2.3.4"}', '{"vp": "1.2', "[1]", "", '{"anomaly": [2]}', "{vp}"]
    lines = spark.createDataFrame([("f", v) for v in values], "file_path STRING, value STRING")
    dead = DeadLetters(str(tmp_path / "dead"), "parsed-test")
    good = skip_malformed(lines, PROBE_LINE, dead=dead)
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan and "parsed-test" in "".join(good.inputFiles())  # both sinks read what was parsed before
    assert [r.value for r in good.collect()] == values[:1]
    found = {r.reason: r.characters for r in spark.read.parquet(dead.path).collect()}
    assert found == {"cut off": 11, "no object": 3, "no text": 0, "a field of another type": 16, "no JSON": 4}


def test_rates_fill_what_the_profile_lacks(spark):
    rows = spark.createDataFrame(
        [("s", "1.1.1.1", None, 0.5, None), ("s", "2.2.2.2", None, None, None)],
        "source STRING, resolver_ip STRING, resolver_connect_error_rate DOUBLE, resolver_invalid_cert_rate DOUBLE, resolver_non_zero_rcode_rate DOUBLE",
    )
    rates = spark.createDataFrame([("s", "1.1.1.1", 4, 0.25, 1.0, 0.0)], "source STRING, resolver_ip STRING, domains BIGINT, connect_error_rate DOUBLE, invalid_cert_rate DOUBLE, non_zero_rcode_rate DOUBLE")
    assert sorted(map(tuple, fill_error_rates(rows, rates).collect()), key=lambda r: r[1]) == [("s", "1.1.1.1", 0.25, 0.5, 0.0), ("s", "2.2.2.2", None, None, None)]


def test_staged_rows_are_removed_after_an_error(spark, tmp_path):
    import os

    before = set(os.listdir(shared_folder(spark)))
    with pytest.raises(EmptyResult):
        fail_if_empty(rows_of(spark, "s", 0), str(tmp_path / "none"))
    assert set(os.listdir(shared_folder(spark))) == before
