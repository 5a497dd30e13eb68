"""Hard negatives by a GNAT-style multiway hyperplane tree.

Vectors become whole numbers, floor(``SCALE`` * x), and are lifted by one coordinate,
sqrt(M**2 - |x|**2) with M the greatest length of all, so that all have length M. An
anchor is lifted by 0. Then distance**2 = |a|**2 + M**2 - 2 * score: high scores are near,
and a window of scores is an annulus around the anchor in a metric space.

* **Tree.** Each inner node has up to ``FAN`` split points, chosen far apart from a sample
  (the row of smallest hash in each of ``SAMPLE`` buckets, which alone reaches the driver);
  a row goes to the nearest split point of each node down to a leaf. Leaves number
  ``LEAVES`` at most, fewer for fewer rows; rows of a leaf lie in as many blocks of some
  ``BLOCK`` rows as it takes.
* **Ranges.** For each pair of split point i and sibling subtree j the least and greatest
  distance from i to the rows of j, over all rows.
* **Search.** An annulus [lo, hi] around the anchor, at distance d from split point i, can
  meet only rows whose distance from i is within [max(d - hi, lo - d), d + hi]; a subtree
  whose range from any of the split points misses that is eliminated. Leaves that are left
  are compared exactly, a block of rows with a block of anchors at a time. Blocks lie in
  groups; an anchor travels once to each group that has blocks of its leaves, with a list of
  these leaves. Both sides are shuffled whatever size the planner expects: it cannot tell in
  how many leaves an anchor looks, so a broadcast could outgrow the driver.

Positives are the nearest rows of the anchor's label: its own leaf gives a first bound, the
ball of that bound the rest. Negatives of a positive are the best in its window of scores:
again the own leaf narrows the windows and the annulus of all windows of an anchor is
searched. All bounds are exact, so are the results; the tree only decides what is read.

Defined cases: rows without id, label or vector, or with a null or non-finite component,
or longer than 2**26 after scaling (where products are exact) take no part; rows equal in id, label and vector are one row; rows of
one id that differ are different rows; of vectors of unlike length the shorter ends in
zeros; ties go to the smaller id; without anchors, positives or negatives there are no
rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlake.llm.common import ready
from scanlake.llm.tables import Tables
from scanlake.operators.joins import lookup_join

SCALE = 256
FAN, LEAVES, SAMPLE = 16, 1024, 16384
#: Rows of a block and anchors of a search block; a leaf is to have a quarter of a block.
BLOCK, ASKED = 1024, 128
#: Groups of blocks, and blocks of a group above which there are more groups: a task holds one group at a time.
GROUPS, GROUP_BLOCKS = 64, 128
N_POSITIVES, N_NEGATIVES = 5, 5
#: A negative scores within these shares of its positive, in percent.
LEAST, MOST = 80, 100


class Node(NamedTuple):
    """Split points (lifted) and for each the number of the child node, or of the leaf as -1 - leaf."""

    points: np.ndarray
    children: list[int]


def far_apart(rows: np.ndarray, count: int) -> np.ndarray:
    """Indexes of distinct rows, each next one the farthest from those before."""
    chosen = [0]
    gap = ((rows - rows[0]) ** 2).sum(axis=1)
    while len(chosen) < count and gap.max() > 0:
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((rows - rows[chosen[-1]]) ** 2).sum(axis=1))
    return np.array(chosen)


def nearest(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All lifted vectors have one length: the nearest has the greatest product."""
    return np.argmax(rows @ points.T, axis=1)


def fit(sample: np.ndarray, fan: int = FAN, leaves: int = LEAVES) -> list[Node]:
    """The tree of a sample: the largest part is split until there are enough leaves."""
    nodes: list[Node] = []
    parts = [(sample, None, 0)]  # rows, parent and place there
    done: list[tuple] = []
    while parts:
        rows, parent, place = parts.pop(max(range(len(parts)), key=lambda i: len(parts[i][0])))
        room = leaves - len(done) - len(parts)
        points = rows[far_apart(rows, min(fan, room))] if len(rows) > 2 * fan and room > 1 else rows[:0]
        if len(points) < 2:
            done.append((parent, place))
            continue
        near = nearest(points, rows)
        if parent is not None:
            nodes[parent].children[place] = len(nodes)
        parts += [(rows[near == i], len(nodes), i) for i in range(len(points))]
        nodes.append(Node(points, [0] * len(points)))
    for leaf, (parent, place) in enumerate(done):
        if parent is not None:
            nodes[parent].children[place] = -1 - leaf
    return nodes


def lifted(rows: np.ndarray, square: float) -> np.ndarray:
    return np.hstack([rows, np.sqrt(np.maximum(square - (rows**2).sum(axis=1, keepdims=True), 0.0))])


def descend(nodes: list[Node], rows: np.ndarray) -> tuple[np.ndarray, list[tuple]]:
    """The leaf of each lifted row, and for each node met (node, child, least and greatest distance from every split point)."""
    leaf, ranges = np.zeros(len(rows), np.int64), []
    todo = [(0, np.arange(len(rows)))] if nodes else []
    while todo:
        at, which = todo.pop()
        node = nodes[at]
        products = rows[which] @ node.points.T
        near = products.argmax(axis=1)
        off = np.sqrt(np.maximum(2 * ((node.points[0] ** 2).sum() - products), 0.0))
        for child in np.unique(near):
            here = near == child
            ranges.append((at, int(child), off[here].min(axis=0), off[here].max(axis=0)))
            if node.children[child] < 0:
                leaf[which[here]] = -1 - node.children[child]
            else:
                todo.append((node.children[child], which[here]))
    return leaf, ranges


def surviving(nodes: list[Node], ranges: dict, queries: np.ndarray, square: float, low: np.ndarray, high: np.ndarray) -> list[np.ndarray]:
    """For each query the leaves that rows at a distance within [low, high] may lie in."""
    if not nodes:
        return [np.zeros(1, np.int64)] * len(queries)
    own = (queries**2).sum(axis=1)
    slack = 1e-6 * (np.sqrt(own) + np.sqrt(square)) + 1e-9  # for rounding
    found: list[list[int]] = [[] for _ in queries]
    todo = [(0, np.arange(len(queries)))]
    while todo:
        at, which = todo.pop()
        node = nodes[at]
        off = np.sqrt(np.maximum(own[which, None] + square - 2 * queries[which] @ node.points[:, :-1].T, 0.0))
        least = np.maximum(off - high[which, None], low[which, None] - off) - slack[which, None]
        most = off + high[which, None] + slack[which, None]
        for child, to in enumerate(node.children):
            if (at, child) not in ranges:
                continue  # no row went there
            nearest_, farthest = ranges[at, child]
            left = which[~((farthest < least) | (nearest_ > most)).any(axis=1)]
            if to >= 0 and len(left):
                todo.append((to, left))
            elif to < 0:
                for q in left:
                    found[q].append(-1 - to)
    return [np.array(sorted(f), np.int64) for f in found]


def packed(rows: DataFrame, row_id: str, label: str, vector: str) -> DataFrame:
    """id, label, v (array of whole doubles) of the rows that take part, each distinct row once."""
    kind = dict(rows.dtypes)[label]
    key = F.col(label).cast("bigint") if kind in ("tinyint", "smallint", "int", "bigint") else F.xxhash64(F.col(label).cast("string"))
    key = F.when(F.col(label).isNotNull(), key)
    named = rows.select(F.col(row_id).cast("bigint").alias("id"), key.alias("label"), F.col(vector).cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    whole = named.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).where(sound)
    whole = whole.withColumn("v", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")))
    whole = whole.withColumn("square", F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).where(F.col("square") <= 2.0**52)
    return whole.dropDuplicates(["id", "label", "v"])


def _matrix(vectors: pa.Array, size: int) -> np.ndarray:
    out = np.zeros((len(vectors), size))
    for i, v in enumerate(vectors):
        v = v.values.to_numpy(zero_copy_only=False)
        out[i, : len(v)] = v
    return out


def _placed(batches: Iterator[pa.RecordBatch], nodes: list[Node], square: float, size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = _matrix(batch.column(2), size)
        leaf, _ = descend(nodes, lifted(rows, square))
        data = pa.array([r.tobytes() for r in rows], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), data, pa.array(leaf)], names=["id", "label", "v", "leaf"])


def _ranges(batches: Iterator[pa.RecordBatch], nodes: list[Node], square: float) -> Iterator[pa.RecordBatch]:
    """Ranges of a task's rows, a record for each node and child."""
    known: dict[tuple, tuple] = {}
    for batch in batches:
        if batch.num_rows:
            rows = np.frombuffer(b"".join(batch.column(0).to_pylist())).reshape(batch.num_rows, -1)
            for at, child, low, high in descend(nodes, lifted(rows, square))[1]:
                old = known.get((at, child), (low, high))
                known[at, child] = np.minimum(old[0], low), np.maximum(old[1], high)
    out = [{"node": at, "child": child, "low": low.tolist(), "high": high.tolist()} for (at, child), (low, high) in known.items()]
    fields = [("node", pa.int64()), ("child", pa.int64()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64()))]
    yield pa.RecordBatch.from_pylist(out, schema=pa.schema(fields))


class Index(NamedTuple):
    """Placed rows (id, label, v, leaf), the same in blocks (group, leaf, ids, labels, vectors), the groups of each leaf, and the tree."""

    rows: DataFrame
    blocks: DataFrame
    groups: list[tuple[int, int]]
    nodes: list[Node]
    ranges: dict
    square: float


def groups_of(block_counts: list[int]) -> tuple[int, list[int], list[tuple[int, int]]]:
    """Number of groups, the place of the first block of each leaf, and its first and last group.

    Blocks are numbered through the leaves and cut into groups of equal size: those of a
    full leaf lie in as many groups as it takes.
    """
    counts = [max(n, 1) for n in block_counts] or [1]
    total = sum(counts)
    groups = max(min(total, GROUPS), -(-total // GROUP_BLOCKS))
    first = np.cumsum([0, *counts[:-1]]).tolist()
    return groups, first, [(f * groups // total, (f + n - 1) * groups // total) for f, n in zip(first, counts)]


def build(rows: DataFrame, tables: Tables, fan: int = FAN, leaves: int = LEAVES, block: int = BLOCK) -> Index:
    """Tree from a bounded sample of the rows (id, label, v, square), every row placed in it."""
    bounds = rows.agg(F.max("square"), F.max(F.size("v")), F.count(F.lit(1))).first()
    square, size = bounds[0] or 0.0, bounds[1] or 1
    leaves = min(leaves, 1 + 4 * bounds[2] // block)
    bucket = F.pmod(F.xxhash64("id", "label"), F.lit(SAMPLE))
    sample = rows.groupBy(bucket).agg(F.min_by("v", F.struct(F.xxhash64("label", "id"), "id", "label")).alias("v")).collect()
    drawn = np.zeros((len(sample), size))
    for i, row in enumerate(sample):
        drawn[i, : len(row.v)] = row.v
    nodes = fit(lifted(drawn[np.lexsort(drawn.T)], square), fan, leaves) if len(sample) else []
    place = partial(_placed, nodes=nodes, square=square, size=size)
    placed = tables.written(rows.select("id", "label", "v").mapInArrow(place, "id BIGINT, label BIGINT, v BINARY, leaf BIGINT"), "placed")
    range_type = "node BIGINT, child BIGINT, low ARRAY<DOUBLE>, high ARRAY<DOUBLE>"
    ends = placed.select("v").mapInArrow(partial(_ranges, nodes=nodes, square=square), range_type)
    each = ends.select("node", "child", F.posexplode(F.arrays_zip("low", "high")).alias("point", "r"))
    each = each.groupBy("node", "child", "point").agg(F.min("r.low").alias("low"), F.max("r.high").alias("high"))
    ranges: dict = {}
    for r in each.collect():  # FAN * FAN a node at most
        low, high = ranges.setdefault((r.node, r.child), (np.zeros(len(nodes[r.node].points)), np.zeros(len(nodes[r.node].points))))
        low[r.point], high[r.point] = r.low, r.high
    filled = {r.leaf: r["count"] for r in placed.groupBy("leaf").count().collect()}
    block_counts = [-(-filled.get(leaf, 0) // block) for leaf in range(max(filled, default=0) + 1)]
    groups, first, spans = groups_of(block_counts)
    at = (F.col("leaf") + 1).cast("int")
    number = F.pmod(F.xxhash64("id", "label", "v"), F.greatest(F.element_at(F.lit(block_counts or [1]), at), F.lit(1)))
    lists = placed.withColumn("block", number).groupBy("leaf", "block").agg(F.array_sort(F.collect_list(F.struct("id", "label", "v"))).alias("r"))
    group = F.floor((F.element_at(F.lit(first), at) + F.col("block")) * groups / sum(max(n, 1) for n in block_counts or [1])).cast("bigint")
    blocks = tables.written(lists.select(group.alias("group"), "leaf", F.col("r.id").alias("ids"), F.col("r.label").alias("labels"), F.col("r.v").alias("vectors")), "blocks")
    return Index(placed, blocks, spans, nodes, ranges, square)


#: Of an asked anchor: its number, id, label and vector, and per slot the scores it looks for, from least to most.
_ASKED = "q BIGINT, id BIGINT, label BIGINT, v BINARY, least ARRAY<DOUBLE>, most ARRAY<DOUBLE>"
#: Where it looks: its leaves in each group.
_REACH = "reach ARRAY<STRUCT<group: BIGINT, leaves: ARRAY<BIGINT>>>"
_REACH_TYPE = pa.list_(pa.struct([("group", pa.int64()), ("leaves", pa.list_(pa.int64()))]))


def reach_of(leaves: Iterable[int], groups: list[tuple[int, int]]) -> list[dict]:
    """Leaves by group: a leaf is in each group that has blocks of it."""
    by_group: dict[int, list[int]] = {}
    for leaf in leaves:
        first, last = groups[leaf]
        for group in range(first, last + 1):
            by_group.setdefault(group, []).append(int(leaf))
    return [{"group": g, "leaves": found} for g, found in by_group.items()]


def _reached(batches: Iterator[pa.RecordBatch], nodes: list[Node], ranges: dict, square: float, groups: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    """Where each anchor looks beside its own leaf, the last column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        queries = np.frombuffer(b"".join(batch.column(3).to_pylist())).reshape(batch.num_rows, -1)
        own = (queries**2).sum(axis=1) + square
        far = np.sqrt(np.maximum(own - 2 * np.array([min(x) for x in batch.column(4).to_pylist()]), 0.0))
        near = np.sqrt(np.maximum(own - 2 * np.array([max(x) for x in batch.column(5).to_pylist()]), 0.0))
        leaves = surviving(nodes, ranges, queries, square, near, far)
        reach = [reach_of(found[found != leaf], groups) for found, leaf in zip(leaves, batch.column(6).to_pylist())]
        yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(reach, _REACH_TYPE)], names=[*batch.schema.names[:6], "reach"])


def _compared(batches: Iterator[pa.RecordBatch], same: bool, count: int) -> Iterator[pa.RecordBatch]:
    """A block of anchors with a block of rows: for each anchor and slot its best rows."""
    names = ["q", "slot", "score", "other"]
    for batch in batches:
        out: list[list[np.ndarray]] = [[] for _ in names]
        for anchors, leaf, ids, labels, vectors in zip(*(batch.column(i) for i in range(5))):
            leaf = leaf.as_py()
            anchors = [a for a in anchors.as_py() if leaf in a["leaves"]]
            ids, labels = (x.values.to_numpy() for x in (ids, labels))
            rows = np.frombuffer(b"".join(vectors.as_py())).reshape(len(ids), -1)
            asked = np.frombuffer(b"".join(a["v"] for a in anchors)).reshape(len(anchors), -1)
            scores = (asked @ rows.T).astype(np.int64)  # whole numbers below 2**53: exact
            for a, vector, score in zip(anchors, asked, scores):
                fits = (labels == a["label"]) == same
                if same:
                    own = np.flatnonzero(fits & (ids == a["id"]))
                    fits[own[(rows[own] == vector).all(axis=1)]] = False  # itself
                for slot, (least, most) in enumerate(zip(a["least"], a["most"])):
                    which = np.flatnonzero(fits & (score >= least) & (score <= most))
                    which = which[np.lexsort((ids[which], -score[which]))][:count]
                    for to, values in zip(out, (np.full(len(which), a["q"]), np.full(len(which), slot), score[which], ids[which])):
                        to.append(values)
        columns = [pa.array(np.concatenate(c).astype(np.int64) if c else np.empty(0, np.int64)) for c in out]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def search(index: Index, asked: DataFrame, same: bool, count: int, chunks: int) -> DataFrame:
    """The best ``count`` rows (q, slot, score, other, rank) of each asked anchor within its ``reach``, by slot."""
    each = asked.select("q", "id", "label", "v", "least", "most", F.pmod(F.xxhash64("q"), F.lit(chunks)).alias("chunk"), F.explode("reach").alias("to"))
    anchor = F.struct("q", "id", "label", "v", "least", "most", F.col("to.leaves").alias("leaves"))
    grouped = each.groupBy(F.col("to.group").alias("group"), "chunk").agg(F.collect_list(anchor).alias("anchors"))  # some ASKED
    grouped = grouped.withColumn("wanted", F.array_distinct(F.flatten("anchors.leaves"))).hint("merge")
    met = grouped.join(index.blocks.hint("merge"), (grouped["group"] == index.blocks["group"]) & F.array_contains("wanted", F.col("leaf")))
    met = met.select("anchors", "leaf", "ids", "labels", "vectors")
    found = met.mapInArrow(partial(_compared, same=same, count=count), "q BIGINT, slot BIGINT, score BIGINT, other BIGINT")
    return best(found, count)


def best(found: DataFrame, count: int) -> DataFrame:
    order = Window.partitionBy("q", "slot").orderBy(F.desc("score"), "other")
    return found.select("q", "slot", "score", "other").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def two_steps(index: Index, asked: DataFrame, same: bool, count: int, chunks: int, tables: Tables) -> DataFrame:
    """Best rows of each slot: of the own leaf first; what these reach bounds the search of the tree."""
    ends = [F.element_at(F.lit([g[end] for g in index.groups]), (F.col("leaf") + 1).cast("int")) for end in (0, 1)]
    own = F.transform(F.sequence(*ends), lambda g: F.struct(g.cast("bigint").alias("group"), F.array("leaf").alias("leaves")))
    first = tables.written(search(index, asked.withColumn("reach", own), same, count, chunks), "own-leaf")
    full = first.where(F.col("rank") == count).groupBy("q").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("reached"))  # a score per slot
    bounded = lookup_join(asked, full.hint("merge"), ["q"])
    raised = F.transform("least", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("reached", i.cast("bigint")).cast("double"), x)))
    bounded = bounded.withColumn("least", raised).select("q", "id", "label", "v", "least", "most", "leaf")
    look = partial(_reached, nodes=index.nodes, ranges=index.ranges, square=index.square, groups=index.groups)
    rest = bounded.mapInArrow(look, f"{_ASKED}, {_REACH}")
    return tables.written(best(first.union(search(index, rest, same, count, chunks)), count), "best")


def _hundredth(value: Column) -> Column:
    """floor(value / 100) of a whole number, as a double."""
    return ((value - F.pmod(value, F.lit(100))) / 100).cast("double")


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    row_id: str = "id",
    label: str = "label",
    vector: str = "vector",
    positives: int = N_POSITIVES,
    negatives: int = N_NEGATIVES,
    fan: int = FAN,
    leaves: int = LEAVES,
    block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``is_anchor`` is a condition on the column ``id``.
    """
    spark = ready(rows.sparkSession)
    with Tables(spark, "negatives") as tables:
        index = build(tables.written(packed(rows, row_id, label, vector), "vectors"), tables, fan, leaves, block)
        number = lambda x: F.array(F.lit(x).cast("double"))
        anchors = index.rows.where(is_anchor).withColumns({"q": F.monotonically_increasing_id(), "least": number(float("-inf")), "most": number(float("inf"))})
        anchors = tables.written(anchors, "anchors")
        chunks = max(1, -(-anchors.count() // ASKED))
        near = two_steps(index, anchors, True, positives, chunks, tables)
        # Windows of an anchor's positives, by the rank of each.
        windows = near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct("rank", "score", "other"))).alias("p"))
        asked = lookup_join(anchors.drop("least", "most"), windows.hint("merge"), ["q"], "inner")
        asked = asked.withColumns({"least": F.transform("p", lambda p: -_hundredth(-LEAST * p["score"])), "most": F.transform("p", lambda p: _hundredth(MOST * p["score"]))})
        asked = tables.written(asked, "windows")
        far = two_steps(index, asked.drop("p"), False, negatives, chunks, tables)
        named = lookup_join(far, asked.select("q", F.col("id").alias("anchor_id"), "p").hint("merge"), ["q"], "inner")
        positive = F.element_at("p", (F.col("slot") + 1).cast("int"))
        return tables.result(
            named.select(
                "anchor_id", positive["other"].alias("positive_id"), "rank", F.col("other").alias("negative_id"),
                positive["score"].alias("positive_score"), F.col("score").alias("negative_score"),
            )
        )
