"""Ranges of a written table."""

import pytest
from pyspark.sql import functions as F

from scanlake.sources import sinks


@pytest.mark.parametrize("partitions", [None, 2])
def test_ranges_follow_the_rows(spark, tmp_path, monkeypatch, partitions):
    monkeypatch.setattr(sinks, "RANGE_ROWS", 100)
    table = spark.range(1000).select(F.lit("2022-01-01").alias("date"), F.lit("US").alias("server_country"), F.col("id").alias("server_asn"))
    path = str(tmp_path / "table")
    sinks.write_base_table(table, path, partitions=partitions)
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"), F.min("server_asn").alias("low"), F.max("server_asn").alias("high")).orderBy("low").collect()
    assert sum(f.n for f in files) == 1000 and len(files) >= 8 and max(f.n for f in files) <= 200
    assert all(a.high < b.low for a, b in zip(files, files[1:]))
