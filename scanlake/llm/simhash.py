"""SimHash near duplicates through segment bit counts.

A fingerprint of 64 bits is cut into ``SEGMENTS`` segments; the vector of their bit
counts is its embedding. Flipping a bit changes one count by one, so the Manhattan
distance of two embeddings is at most the Hamming distance of the fingerprints: pairs
within 2 bits have embeddings within 2. The grid has a cell per embedding. Each distinct
fingerprint is stored in its own cell and asks in the cells within distance 2 that are
not smaller than its own, so that each pair meets once; the exact distance is verified
in the join. Equal fingerprints are folded before that, so a group of copies counts as
one, and a fingerprint has at most 64 + 64 * 63 / 2 = 2080 others within 2 bits: links
grow with the number of distinct fingerprints, never with the square of a group.

Components are found by rounds of neighbour exchange (each node adopts the smallest
label near it, and labels are shortened by one more hop) over written tables.

Defined cases: a null text counts as empty; no word gives fingerprint zero; a null
doc_id takes part and is smaller than no other (component_id is the smallest non-null
doc_id of the component, null if there is none); repeated rows are given back as often
as they come; an empty table gives an empty result; other columns are ignored. Where
documents are dropped, rows are told apart by a digest of all their columns, never by
doc_id alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import free_name, ready, written
from scanlake.operators.joins import lookup_join

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 2
#: Segments of the embedding; each has BITS / SEGMENTS bits.
SEGMENTS = 8


def fingerprint(text: str | None) -> int:
    """SimHash over word shingles: a bit is 1 if set in over half of the hashes."""
    words = (text or "").encode().lower().split()  # bytes.split parts at 0x20 and 0x09-0x0D
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 14):  # a long text needs no more memory than a short one
        block = hashes[start : start + (1 << 14)]
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    set_bits = (2 * counts > len(hashes)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
        carried = batch.schema.names[2:]
        columns = [batch.column(0), *batch.columns[2:], pa.array(found.view(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *carried, "fp"])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a signed number) of every row."""
    ready(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(_fingerprints, "doc_id BIGINT, fp BIGINT")


def probe_offsets(segments: int, radius: int) -> list[tuple[int, ...]]:
    """Count differences within the radius whose first non-zero entry is positive, and zero."""
    found = [(0,) * segments]
    for used in range(1, radius + 1):
        for places in combinations(range(segments), used):
            for steps in product(range(-radius, radius + 1), repeat=used):
                if all(steps) and sum(map(abs, steps)) <= radius and steps[0] > 0:
                    offset = [0] * segments
                    for place, step in zip(places, steps):
                        offset[place] = step
                    found.append(tuple(offset))
    return found


def links(distinct: DataFrame, segments: int = SEGMENTS, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints within the radius, each pair once.

    The cell is the embedding as a number with a digit per segment; the digits have room
    for the radius on both sides, so adding an offset never carries into the next digit.
    """
    width = BITS // segments
    base = width + 1 + 2 * radius
    mask = (1 << width) - 1
    count = lambda i: F.bit_count(F.shiftrightunsigned("fp", i * width).bitwiseAND(F.lit(mask))).cast("bigint")
    cell = sum(((count(i) + radius) * base ** (segments - 1 - i) for i in range(segments)), F.lit(0).cast("bigint"))
    homes = distinct.select(F.col("fp").alias("b"), cell.alias("cell"))
    steps = [sum(step * base ** (segments - 1 - i) for i, step in enumerate(offset)) for offset in probe_offsets(segments, radius)]
    asked = distinct.select(F.col("fp").alias("a"), cell.alias("own"), F.explode(F.lit(steps)).alias("step"))
    asked = asked.select("a", (F.col("own") + F.col("step")).alias("cell"), "own")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    once = (F.col("cell") != F.col("own")) | (F.col("a") < F.col("b"))
    return asked.join(homes, "cell").where(near & once).select("a", "b")


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """Node and label: the smallest node reachable over the edges (a, b).

    Large-star and small-star rounds in turn: each hangs the larger neighbours of a node
    on its smallest one, until the edges no longer change. They form stars then.
    """
    edges = written(edges.select("a", "b"), "links")
    last = None
    for _ in range(rounds):
        both = edges.union(edges.select("b", "a"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = lookup_join(both, low, ["a"], "inner").where("b > a and b != low").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = written(large, "large-star")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b")
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        hung = lookup_join(down, low, ["a"], "inner")
        small = hung.select("a", F.col("low").alias("b")).union(hung.where("b != low").select(F.col("b"), F.col("low")))
        edges = written(small.distinct(), "small-star")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("bigint"))).first()
        if state == last:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
        last = state
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def labelled(found: DataFrame, segments: int = SEGMENTS) -> DataFrame:
    """One row per fingerprint: fp, class (the smallest fingerprint of its component), component_id, n_links."""
    distinct = written(found.groupBy("fp").agg(F.min("doc_id").alias("low_id")), "distinct-fingerprints")
    pairs = written(links(distinct.select("fp"), segments), "fingerprint-links")
    labels = components(pairs)
    degree = pairs.select("a").union(pairs.select("b")).groupBy(F.col("a").alias("fp")).agg(F.count(F.lit(1)).alias("n_links"))
    classes = distinct.join(labels.withColumnRenamed("node", "fp"), "fp", "left")
    classes = classes.select("fp", "low_id", F.coalesce("label", "fp").alias("class"))
    smallest = classes.groupBy("class").agg(F.min("low_id").alias("component_id"))
    known = lookup_join(lookup_join(classes, smallest, ["class"]), degree, ["fp"])
    return known.select("fp", "class", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", segments: int = SEGMENTS) -> DataFrame:
    """One row per document: doc_id, fp, fingerprint (hex), component_id, n_links.

    n_links counts the other distinct fingerprints within 2 bits.
    """
    found = written(fingerprints(docs, doc_id, text), "fingerprints")
    known = labelled(found, segments).select("fp", "component_id", "n_links")
    # A third of all rows may have one fingerprint; such a lookup join can be split.
    return lookup_join(found, known, ["fp"], "inner").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")


def drop_near(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with all their columns; of each component one row stays.

    It is one of smallest doc_id, or without any if the component has no doc_id at all; of
    several such rows that with the smallest digest of its columns. Of rows that are equal
    in all columns it makes no difference which one stays.
    """
    ready(docs.sparkSession)
    row = F.coalesce(F.unhex(F.sha2(F.to_json(F.struct("*")), 256)), F.lit(b""))
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), row.alias("row"))
    found = written(narrow.mapInArrow(_fingerprints, "doc_id BIGINT, row BINARY, fp BIGINT"), "fingerprints")
    classes = lookup_join(found, labelled(found).select("fp", "class"), ["fp"], "inner")
    times = classes.groupBy("class", "doc_id", "row").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "n"))
    name = free_name(docs.columns, "row")
    stays = times.groupBy("class").agg(first.alias("first")).select(F.col("first.row").alias(name), F.col("first.n").alias("n"))
    stays = written(stays, "near-keepers")
    keyed = docs.select("*", row.alias(name))
    kept = lookup_join(keyed, stays.where("n = 1").select(name), [name], "left_semi").drop(name)
    if stays.where("n > 1").isEmpty():
        return kept
    # Rows that come more than once as a whole: one of each, by partial aggregates.
    equal = lookup_join(keyed, stays.where("n > 1").select(name), [name], "left_semi")
    one = equal.groupBy(name).agg(F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("one"))
    return kept.union(one.select("one.*"))
