"""Connected components over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.tables import Tables
from scanlake.operators.joins import lookup_join


def components(edges: DataFrame, tables: Tables) -> DataFrame:
    """Node and label: the smallest node reachable over the edges (a, b).

    Large-star and small-star rounds in turn: each hangs the larger neighbours of a node
    on its smallest one, until the set of edges stays as it is. They form stars then.
    The state of a round is a table; those of earlier rounds are removed.
    """
    edges, known = tables.written(edges.select("a", "b"), "links"), None
    while True:
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = lookup_join(both, low, ["a"], "inner").where("b > a and b != low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = tables.written(large, "large-star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        hung = lookup_join(down, low, ["a"], "inner")
        small = hung.select("a", F.col("low").alias("b")).union(hung.where("b != low").select(F.col("b"), F.col("low")))
        last, edges = edges, tables.written(small.distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("bigint"))).first()
        # Sets of equal count and hash are compared themselves.
        if state == known and edges.join(last, ["a", "b"], "left_anti").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        known = state
        tables.remove(large, last)
