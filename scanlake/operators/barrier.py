"""Keep costly expressions from being copied by the optimizer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Add computed columns that later filters read instead of recomputing.

    A filter on a plain computed column is pushed below the projection together with
    a copy of the whole expression. The output of a generator is not rewritten that
    way; the generator here yields exactly one record per row.
    """
    computed = F.struct(*[c.alias(n) for n, c in columns.items()])
    exploded = rows.select("*", F.explode_outer(F.array(computed)).alias("__computed"))
    return exploded.select(*rows.columns, *[F.col(f"__computed.{n}").alias(n) for n in columns])


def explode_once(rows: DataFrame, kept: list, items: Column, position: str, item: str) -> DataFrame:
    """Explode an array that is costly to compute, evaluating it once per row.

    An inner explode makes the optimizer derive a filter on the array and copy the
    whole computation below; the outer form does not, and its empty records are
    dropped here.
    """
    exploded = rows.select(*kept, F.posexplode_outer(items).alias(position, item))
    return exploded.filter(F.col(position).isNotNull())
