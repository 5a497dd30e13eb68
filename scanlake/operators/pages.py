"""Flatten page fetch lines: one http and one https row per line."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.functions.paths import source_of
from scanlake.functions.text import iso_timestamp
from scanlake.operators.lines import skip_malformed
from scanlake.operators.received import add_received
from scanlake.schemas import PAGE_FETCH_LINE


def flatten_page_fetch(lines: DataFrame) -> DataFrame:
    """Each payload is an error text, a response object, or missing.

    A quote inside a JSON string is always escaped, so an unescaped key followed
    by an opening brace can only be the object form of that key.
    """
    scans = skip_malformed(lines, PAGE_FETCH_LINE)
    scan, value = F.col("scan"), F.col("value")
    fetches = F.array(
        *[
            F.struct(
                F.lit(https).alias("https"),
                scan[key].alias("payload"),
                value.rlike(rf'(?<!\\)"{key}"\s*:\s*\{{').alias("is_object"),
            )
            for key, https in (("http", False), ("https", True))
        ]
    )
    exploded = scans.select("file_path", "scan", F.explode(fetches).alias("fetch"))
    c = F.col
    rows = exploded.select(
        c("scan.keyword").alias("domain"),
        c("scan.ip").alias("ip"),
        F.substring("scan.start_time", 1, 10).alias("date"),
        iso_timestamp(c("scan.start_time")).alias("start_time"),
        iso_timestamp(c("scan.end_time")).alias("end_time"),
        c("scan.fetched").alias("success"),
        c("fetch.https").alias("https"),
        source_of(c("file_path")).alias("source"),
        F.when(~c("fetch.is_object"), c("fetch.payload")).alias("error"),
        F.when(c("fetch.is_object"), c("fetch.payload")).alias("payload"),
        c("fetch.is_object").alias("payload_is_object"),
        c("scan.trusted_cert").alias("trusted"),
    )
    trusted = F.when(c("payload_is_object") & c("https"), c("trusted"))
    received = add_received(rows, "payload", "payload_is_object", keep_body=False)
    return received.withColumn(
        "received", c("received").withField("tls_cert_has_trusted_ca", trusted)
    ).drop("payload", "trusted")
