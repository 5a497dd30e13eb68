"""Shared pieces of the registered queries.

Relations that need no arrays are written once, in the SQL both engines share, with
``{table}`` for a given table.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.session import configure

MISSING = "~"


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None):
    """Register a query under its key together with its SQL."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        def configured(spark: SparkSession, sf: str) -> DataFrame:
            return run(configure(spark), sf)

        REGISTRY[key] = Query(configured, None if sql is None else plain(sql))
        return run

    return register


# Dimension tables of a fixed number of rows, or of a few per scale.
SMALL_TABLES = {"region", "nation", "supplier"}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table, dealt out over the cores: it may be one file that one task reads."""
    rows = spark.read.parquet(f"{sf}/{name}.parquet")
    return rows if name in SMALL_TABLES else rows.repartition(spark.sparkContext.defaultParallelism)


def relation(spark: SparkSession, sf: str, sql: str) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", sql))
    return spark.sql(sql, **{name: table(spark, sf, name) for name in names})


def plain(sql: str) -> str:
    """The SQL with table placeholders replaced by the table names."""
    return re.sub(r"\{(\w+)\}", r"\1", sql)


def shown(*columns: str | Column, **named: Column) -> list[Column]:
    """Columns as text, nulls as a mark, so that both engines print them alike."""
    pairs = [(c, F.col(c)) for c in columns] + list(named.items())
    return [F.coalesce(c.cast("string"), F.lit(MISSING)).alias(n) for n, c in pairs]


def shown_sql(*columns: str, **named: str) -> str:
    pairs = [(c, c) for c in columns] + list(named.items())
    return ", ".join(f"coalesce(CAST({e} AS VARCHAR), '{MISSING}') AS {n}" for n, e in pairs)


def rounded(column: str, digits: int = 6) -> Column:
    return F.round(F.coalesce(F.col(column), F.lit(-1.0)), digits).alias(column)


def rounded_sql(expression: str, name: str, digits: int = 6) -> str:
    return f"round(coalesce(CAST({expression} AS DOUBLE), -1.0), {digits}) AS {name}"


def texts_sql(values: list[str]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def ip_text_sql(number: str) -> str:
    """Shared SQL: dotted text of an address number."""
    return (
        f"CAST(CAST(({number} - {number} % 16777216) / 16777216 AS BIGINT) AS STRING) || '.' || "
        f"CAST(CAST(({number} % 16777216 - {number} % 65536) / 65536 AS BIGINT) AS STRING) || '.' || "
        f"CAST(CAST(({number} % 65536 - {number} % 256) / 256 AS BIGINT) AS STRING) || '.' || "
        f"CAST({number} % 256 AS STRING)"
    )


# One measurement per line item; days are moved by 24 years into the time of the formats.
MEASUREMENTS = """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS n,
       CAST(ROUND(l_extendedprice * 100) AS BIGINT) AS cents,
       CAST(CAST(SUBSTR(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 4) AS INT) + 24 AS STRING)
         || SUBSTR(CAST(CAST(l_shipdate AS DATE) AS STRING), 5) AS day,
       l_returnflag AS flag, l_linestatus AS status
FROM {lineitem}
"""
