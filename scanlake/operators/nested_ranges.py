"""Nested address ranges as disjoint ones, each with its innermost owner."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.functions.ips import prefix_bits
from scanlake.session import ship_package

#: Ranges are cut at the borders of blocks of this prefix length.
BLOCK_BITS = 16


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks with their sorted ranges (first, last, size, number) to pieces (first, last, number) of the smallest one."""
    for batch in batches:
        pieces = []
        for ranges in batch.column(0).to_pylist():
            borders = sorted({r["first"] for r in ranges} | {r["last"] + 1 for r in ranges})
            open_: list[tuple] = []  # smallest first; of equal ones that which starts last
            at = 0
            for begin, end in zip(borders, borders[1:]):
                while at < len(ranges) and ranges[at]["first"] == begin:
                    r = ranges[at]
                    heapq.heappush(open_, (r["size"], -r["start"], r["number"], r["last"]))
                    at += 1
                while open_ and open_[0][3] < begin:
                    heapq.heappop(open_)
                if open_:
                    number = open_[0][2]
                    if pieces and pieces[-1][1] + 1 == begin and pieces[-1][2] == number:
                        pieces[-1] = (pieces[-1][0], end - 1, number)
                    else:
                        pieces.append((begin, end - 1, number))
        columns = zip(*pieces) if pieces else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["start_ip", "end_ip", "number"])


def innermost_ranges(ranges: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """Disjoint ranges of the addresses in ``ranges``, each with the values of the smallest range around it.

    ``ranges``: ``start_ip``, ``end_ip`` (numbers) and values, nested or overlapping to any
    depth. Of ranges of one size that overlap the one that starts later owns the overlap; of
    equal ranges the one of greatest values (as text). Rows with a missing border or with
    the end before the start hold no address.

    Ranges are cut at block borders, so that one around many blocks is carried into each as
    a piece, and every block is swept by itself with a heap of the ranges that are open; it
    has 2**(32 - bits) addresses and no more pieces. Only borders and a number travel
    through the sweep; values are joined back.
    """
    ship_package(ranges.sparkSession)
    values = [c for c in ranges.columns if c not in ("start_ip", "end_ip")]
    text = F.struct(F.lit(""), *[F.col(c).cast("string") for c in values])
    sound = ranges.where("start_ip IS NOT NULL AND end_ip IS NOT NULL AND start_ip <= end_ip")
    one = sound.groupBy("start_ip", "end_ip").agg(F.max_by(F.struct(F.lit(1).alias("one"), *values), text).alias("values"))
    width = F.lit(bits)
    blocks = F.sequence(prefix_bits(F.col("start_ip"), width), prefix_bits(F.col("end_ip"), width))
    size = 1 << (32 - bits)
    pieces = one.select("start_ip", "end_ip", F.explode(blocks).alias("block"))
    piece = F.struct(
        F.greatest("start_ip", F.col("block") * size).alias("first"),
        F.least("end_ip", F.col("block") * size + (size - 1)).alias("last"),
        (F.col("end_ip") - F.col("start_ip")).alias("size"),
        F.col("start_ip").alias("start"),
        # Both borders in one number: 32 bits each.
        (F.shiftleft(F.col("start_ip") - (1 << 31), 32) + F.col("end_ip")).alias("number"),
    )
    swept = pieces.groupBy("block").agg(F.array_sort(F.collect_list(piece)).alias("ranges"))
    disjoint = swept.select("ranges").mapInArrow(_sweep, "start_ip BIGINT, end_ip BIGINT, number BIGINT")
    owners = one.select((F.shiftleft(F.col("start_ip") - (1 << 31), 32) + F.col("end_ip")).alias("number"), "values")
    return disjoint.join(owners, "number").select("start_ip", "end_ip", *[F.col(f"values.{c}").alias(c) for c in values])
