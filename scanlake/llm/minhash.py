"""MinHash near duplicates by bottom-k sketches of one hash function.

A document's set are its distinct 5-word shingles, each as its XXH64 value, so that one
hash function names, samples and orders them. Its sketch are the ``K`` smallest; a set of
no more is its own sketch. Equal sets are folded to one class first, so that a group of
copies counts as one. Classes link at ``PERCENT`` % of Jaccard similarity.

1. **Inverted lists.** Of two linked classes, more than ``SHARE`` of the K smallest values
   of the union lie in both sketches (the chance that fewer do is below 3e-14 a link; sets
   of up to ``PERCENT`` % of K values are compared in full and need no chance). So they
   have a value in common among the first ones of each sketch in any common order. Values
   are ordered by how full their bucket is, rare ones first (counts of all values by
   2**20 buckets): passages that many documents share come last and are hardly ever listed.
2. **Short lists** (up to ``SHORT`` classes) give pairs of classes of like size. The
   sketch of their union estimates the similarity; sets as small as their sketch are
   decided by it, the others are confirmed on full sets.
3. **Long lists**, of crowds of near copies, would give a square of pairs. Lists that share
   classes are joined to one crowd, as near copies share most of them. Each crowd is seen
   from a centre instead of pair by pair, the values that over half of some of its classes have: a class
   becomes its difference from the centre, of size s, and with weight w = 3 n - 37 s two
   classes link exactly if w + w' + 74 * (common differences) >= 0, whatever the centre.
   Those that need no common difference all link to the class of greatest weight, one link
   each. Those that do are listed again by their differences, rare ones first and only as
   many as may be needed, and so on until all lists are short. A list whose differences
   part it badly (the lists that follow hold over half its pairs) ends there: its classes
   are compared by differences, block by block. So pairs at least halve at each level.
   Nothing is capped and no list is collected.
4. Components of the links give each document the smallest doc_id that it can reach.

Full sets hold 64-bit values: two different shingles of two texts are taken for the same
with a chance of 2**-64.

Defined cases: a null text or one without words has an empty set and is linked with
nothing; with fewer words than a shingle has the whole sequence is one; a null doc_id
takes part and is smaller than no other (component_id is the smallest non-null doc_id of
the component, null if there is none, and such a row is not kept); repeated rows are given
back as often as they come; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import ready
from scanlake.llm.components import components
from scanlake.llm.tables import Tables
from scanlake.operators.joins import lookup_join

WORDS = 5
SEED = 42
PERCENT = 85
K = 256
#: Share of the union's sketch that lies in both sketches of a link.
SHARE = 0.65
#: Longest inverted list whose pairs are formed.
SHORT = 32
#: Members of a long list that are asked for its centre, about.
ASKED = 8
#: Classes of a block of a dense list, about, and values looked at together.
BLOCK, COLUMNS = 256, 4096
MASK = (1 << 64) - 1
#: Bits of the map that tells which rows a join can need.
MAP_BITS = 23
#: Buckets in which values are counted (4 MB of counts), and parts in which counts travel.
BUCKET_BITS, PART_BITS = 20, 6


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct shingles of a text as sorted 64-bit hashes."""
    words = (text or "").encode().lower().split()  # bytes.split parts at 0x20 and 0x09-0x0D
    if not words:
        return np.empty(0, np.uint64)
    count = max(1, len(words) - WORDS + 1)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(b" ".join(words[i : i + WORDS]), SEED) for i in range(count)), np.uint64, count))


def least_common(n: int, k: int) -> int:
    """How many of a set's (or sketch's) values a link has in common with it at least."""
    if n <= k * PERCENT // 100:
        return -(-n * PERCENT // 100)  # its partners are no larger than a sketch
    return min(n, int(np.ceil(SHARE * k)))


def _sketches(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, digests, sketches = [], [], []
        for text in batch.column(2):
            values = shingle_set(text.as_py())
            sizes.append(len(values))
            data = values.tobytes()
            digests.append(hashlib.blake2b(data, digest_size=16).digest() if data else None)
            sketches.append(data[: 8 * k] or None)
        columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(sketches, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "at", "n", "digest", "sketch"])


def sketched(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """doc_id, at (a digest of the text), n (set size), digest and sketch of the set, of every row."""
    named = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), _at(text).alias("at"), F.col(text).cast("string").alias("text"))
    return named.mapInArrow(partial(_sketches, k=k), "doc_id BIGINT, at BINARY, n BIGINT, digest BINARY, sketch BINARY")


def _at(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")))


def _bucket(values: np.ndarray) -> np.ndarray:
    return (values & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)


def _count_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(1 << BUCKET_BITS, np.int64)
    for batch in batches:
        values = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
        counts += np.bincount(_bucket(values), minlength=len(counts))
    parts = np.split(counts, 1 << PART_BITS)
    used = [i for i, part in enumerate(parts) if part.any()]
    yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array([parts[i].tobytes() for i in used], pa.binary())], names=["part", "counts"])


def _sum_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.int64)
    yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int64()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], names=["part", "counts"])


def bucket_counts(classes: DataFrame) -> np.ndarray:
    """How many values each of 2**BUCKET_BITS buckets has: what reaches the driver, whatever the input."""
    by_task = classes.select("sketch").mapInArrow(_count_values, "part BIGINT, counts BINARY")
    summed = by_task.repartition("part").mapInArrow(_sum_counts, "part BIGINT, counts BINARY")
    counts = np.zeros((1 << PART_BITS, 1 << (BUCKET_BITS - PART_BITS)), np.int64)
    for row in summed.collect():
        counts[row.part] = np.frombuffer(row.counts, np.int64)
    return np.minimum(counts.ravel(), np.iinfo(np.int32).max).astype(np.int32)


def _listed(batches: Iterator[pa.RecordBatch], counts: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists, nodes, sizes = [], [], []
        for node, n, sketch in zip(*(batch.column(i).to_pylist() for i in range(3))):
            values = np.frombuffer(sketch, np.uint64)
            first = values[np.lexsort((values, counts[_bucket(values)]))][: len(values) - least_common(n, k) + 1]
            lists.append(first.view(np.int64))
            nodes.append(np.full(len(first), node, np.int64))
            sizes.append(np.full(len(first), n, np.int64))
        columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64)) for c in (lists, nodes, sizes)]
        yield pa.RecordBatch.from_arrays(columns, names=["list", "node", "n"])


def counted(entries: DataFrame) -> DataFrame:
    """Entries (list, node, n) of lists that have two or more, with the length of their list.

    Of lists with the same members one is kept, as near copies share most of their lists:
    the others would give the same pairs again. Members are compared by their number and
    128 bits of hashes.
    """
    marks = [F.bit_xor(F.xxhash64(F.lit(seed), "node")).alias(f"mark{seed}") for seed in range(2)]
    lengths = entries.groupBy("list").agg(F.count(F.lit(1)).alias("length"), *marks).where("length > 1")
    kept = lengths.groupBy("length", "mark0", "mark1").agg(F.min("list").alias("list")).select("list", "length")
    return lookup_join(entries, kept, ["list"], "inner")


def inverted_lists(classes: DataFrame, counts: np.ndarray, k: int = K) -> DataFrame:
    """Entries (list, node, n, length) of the inverted lists of retained values."""
    listed = partial(_listed, counts=counts, k=k)
    return counted(classes.select("node", "n", "sketch").mapInArrow(listed, "list BIGINT, node BIGINT, n BIGINT"))


def short_pairs(entries: DataFrame) -> DataFrame:
    """Pairs of classes of like size that share a short list."""
    short = entries.select("list", "node", "n")
    left, right = short.toDF("list", "a", "n_a"), short.toDF("list", "b", "n_b")
    like = 100 * F.least("n_a", "n_b") >= PERCENT * F.greatest("n_a", "n_b")
    return left.join(right, "list").where((F.col("a") < F.col("b")) & like).select("a", "b")


def _estimated(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """Whether the union's sketch says link (exact if it is the whole union) or maybe."""
    for batch in batches:
        exact, maybe = [], []
        for n_a, n_b, a, b in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
            a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
            both = np.intersect1d(a, b, assume_unique=True)
            if n_a <= k and n_b <= k:
                exact.append(100 * len(both) >= PERCENT * (n_a + n_b - len(both)))
                maybe.append(False)
            else:
                union = np.union1d(a, b)[:k]
                exact.append(False)
                maybe.append(np.searchsorted(both, union[-1], "right") >= SHARE * len(union))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(exact, pa.bool_()), pa.array(maybe, pa.bool_())], names=["a", "b", "exact", "maybe"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = []
        for a, b in zip(batch.column(2), batch.column(3)):
            a, b = a.values.to_numpy(), b.values.to_numpy()
            both = len(np.intersect1d(a, b, assume_unique=True))
            links.append(100 * both >= PERCENT * (len(a) + len(b) - both))
        kept = pa.array(links, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(kept), batch.column(1).filter(kept)], names=["a", "b"])


def _marked(batches: Iterator[pa.RecordBatch], words: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bit = batch.column(batch.num_columns - 1).to_numpy()
        kept = (words[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1)
        yield pa.RecordBatch.from_arrays(batch.columns[:-1], names=batch.schema.names[:-1]).filter(pa.array(kept.astype(bool)))


def likely(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the given ones, and few others: what a join that follows need not shuffle.

    The keys set bits of a map of 2**MAP_BITS; the map (1 MB) reaches the driver and the tasks.
    """
    bit = lambda: F.pmod(F.xxhash64(key), F.lit(1 << MAP_BITS))
    set_ = keys.select(bit().alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
    words = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for row in set_.agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % 64).cast("int"))).alias("bits")).collect():
        words[row.word] = row.bits
    return rows.withColumn("__bit", bit()).mapInArrow(partial(_marked, words=words.view(np.uint64)), rows.schema)


def _sides(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
    """Pairs with columns of both their classes, named by side."""
    of = likely(of.select("node", *columns), pairs.select(F.explode(F.array("a", "b")).alias("node")), "node")
    for side in ("a", "b"):
        pairs = lookup_join(pairs, of.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), [side], "inner")
    return pairs


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = [shingle_set(t).view(np.int64) if t is not None else np.frombuffer(s, np.int64) for s, t in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.list_(pa.int64()))], names=["node", "values"])


def whole_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, text: str, k: int) -> DataFrame:
    """The full set of each of the given classes: its sketch, or read again from a text that has it."""
    wanted = lookup_join(likely(classes.select("node", "n", "at", "sketch"), nodes, "node"), nodes, ["node"], "left_semi")
    large = wanted.where(F.col("n") > k).select("node", "at")
    texts = likely(docs.select(_at(text).alias("at"), F.col(text).cast("string").alias("text")), large, "at")
    texts = lookup_join(texts, large, ["at"], "inner").groupBy("node").agg(F.any_value("text").alias("text"))
    small = wanted.where(F.col("n") <= k).select("node", "sketch", F.lit(None).cast("string").alias("text"))
    rows = small.union(texts.select("node", F.lit(None).cast("binary"), "text"))
    return rows.mapInArrow(_whole, "node BIGINT, values ARRAY<BIGINT>")


def _first_differences(batches: Iterator[pa.RecordBatch], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(list, node, n, off, first) to an entry for each of the first differences, rare ones first."""
    for batch in batches:
        lists, nodes, sizes, parents = [], [], [], []
        for key, node, n, off, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3), batch.column(4).to_pylist()):
            values = off.values.to_numpy().view(np.uint64)
            chosen = values[np.lexsort((values, counts[_bucket(values)]))][:first]
            lists += [xxhash.xxh64_intdigest(v.tobytes(), key & MASK) for v in chosen]
            nodes += [node] * len(chosen)
            sizes += [n] * len(chosen)
            parents += [key] * len(chosen)
        columns = [pa.array(np.array(lists, np.uint64).view(np.int64)), *(pa.array(c, pa.int64()) for c in (nodes, sizes, parents))]
        yield pa.RecordBatch.from_arrays(columns, names=["list", "node", "n", "parent"])


def dense_lists(used: DataFrame, entries: DataFrame) -> DataFrame:
    """(list, blocks) of the long lists whose differences part them badly.

    The lists that follow hold over half as many pairs as the list itself, repeats counted: the
    same pair would come up again in each of them, and at every further level.
    """
    sizes = used.groupBy("list").agg(F.count(F.lit(1)).alias("size"))
    following = entries.groupBy("parent", "list").agg(F.first("length").alias("length"))
    following = following.groupBy(F.col("parent").alias("list")).agg(F.sum(F.col("length") * (F.col("length") - 1)).alias("pairs"))
    dense = lookup_join(sizes, following, ["list"], "inner").where(2 * F.col("pairs") > F.col("size") * (F.col("size") - 1))
    return dense.select("list", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))


def _block_links(block: pa.Table) -> pa.Table:
    """Links that hold the classes of two blocks (or of one) together: w + w' + 74 * (common differences) >= 0."""
    nodes, weights, own = (block.column(c).to_numpy() for c in ("node", "weight", "own"))
    off = block.column("off").combine_chunks()
    lengths = np.diff(off.offsets.to_numpy())
    values, place = np.unique(off.flatten().to_numpy(), return_inverse=True)
    member = np.repeat(np.arange(len(nodes)), lengths)
    left, right = np.flatnonzero(own == own.min()), np.flatnonzero(own == own.max())
    order = np.argsort(place, kind="stable")
    place, member = place[order], member[order]
    common = np.zeros((len(left), len(right)), np.float32)
    for start in range(0, len(values), COLUMNS):  # a part of the values at a time: memory stays the same
        low, high = np.searchsorted(place, (start, start + COLUMNS))
        has = np.zeros((len(nodes), min(COLUMNS, len(values) - start)), np.float32)
        has[member[low:high], place[low:high] - start] = 1
        common += has[left] @ has[right].T
    a, b = np.nonzero(weights[left][:, None] + weights[right][None, :] + 74 * common.astype(np.int64) >= 0)
    a, b = left[a], right[b]
    # Near copies link with all others: each is named with the lowest class it reaches instead.
    label = np.arange(len(nodes))
    while True:
        before = label.copy()
        np.minimum.at(label, a, before[b])
        np.minimum.at(label, b, before[a])
        label = label[label]
        if np.array_equal(label, before):
            break
    linked = np.flatnonzero(label != np.arange(len(nodes)))
    return pa.table({"a": nodes[linked], "b": nodes[label[linked]]})


def block_links(used: DataFrame, dense: DataFrame) -> DataFrame:
    """Links of dense lists: every two blocks of about BLOCK classes are compared by their differences, once."""
    rows = lookup_join(used.select("list", "node", "off", "weight"), dense, ["list"], "inner")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("list", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "node", "own", "off", "weight")
    return rows.groupBy("list", "low", "high").applyInArrow(_block_links, "a BIGINT, b BIGINT")


def crowd_level(entries: DataFrame, whole: DataFrame, counts: np.ndarray, tables: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links of long lists that need no common difference, the lists of their differences, and the table both read."""
    members = lookup_join(entries.select("list", "node", "n", "length"), whole, ["node"], "inner")
    # Any centre is right, a near one is fast: what most of some ASKED members have. How many
    # were asked is joined while the rows are narrow; the values are shuffled once.
    asked = entries.where(F.pmod(F.xxhash64("list", "node"), F.col("length")) < ASKED).select("list", "node")
    asked = lookup_join(asked, asked.groupBy("list").agg(F.count(F.lit(1)).alias("asked")), ["list"], "inner")
    values = lookup_join(asked, likely(whole, asked.select("node"), "node"), ["node"], "inner").select("list", "asked", F.explode("values").alias("value"))
    shares = values.groupBy("list", "asked", "value").agg(F.count(F.lit(1)).alias("times"))
    centres = shares.where(2 * F.col("times") > F.col("asked")).groupBy("list").agg(F.collect_list("value").alias("centre"))  # under twice a mean set
    seen = lookup_join(members, centres, ["list"]).withColumn("centre", F.coalesce("centre", F.array().cast("array<bigint>")))
    off = F.concat(F.array_except("values", "centre"), F.array_except("centre", "values"))
    used = tables.written(seen.select("list", "node", "n", off.alias("off")).withColumn("weight", 3 * F.col("n") - 37 * F.size("off")), "differences")
    most = used.groupBy("list").agg(F.max(F.struct("weight", "node")).alias("most"))
    seen = lookup_join(used, most, ["list"], "inner").withColumn("lack", -(F.col("weight") + F.col("most.weight")))
    links = seen.where("lack <= 0 and node != most.node").select(F.col("node").alias("a"), F.col("most.node").alias("b"))
    # Pairs that need common differences need at least this many, so one is among the first.
    first = F.size("off") - F.greatest(F.ceil(F.col("lack") / 74), F.lit(1)) + 1
    each = seen.select("list", "node", "n", "off", first.alias("first")).where("first > 0")
    return links, each.mapInArrow(partial(_first_differences, counts=counts), "list BIGINT, node BIGINT, n BIGINT, parent BIGINT"), used


def crowds(long: DataFrame, tables: Tables) -> DataFrame:
    """Long lists that share classes as one: near copies have most of their values, and so their lists, in common."""
    labels = components(long.select(F.col("list").alias("a"), F.col("node").alias("b")), tables)
    named = lookup_join(long.select("node", "n").distinct(), labels, ["node"])
    named = named.select(F.coalesce("label", "node").alias("list"), "node", "n")
    return lookup_join(named, named.groupBy("list").agg(F.count(F.lit(1)).alias("length")), ["list"], "inner")


def class_links(classes: DataFrame, docs: DataFrame, tables: Tables, text: str = "text", k: int = K, short: int = SHORT) -> DataFrame:
    """Links (a, b) between classes (node, n, at, sketch) that hold every component together."""
    counts = bucket_counts(classes)
    entries = tables.written(inverted_lists(classes, counts, k), "lists")
    pairs, links = [short_pairs(entries.where(F.col("length") <= short))], []
    long = entries.where(F.col("length") > short)
    if not long.isEmpty():
        long = tables.written(crowds(long, tables), "crowds")
        whole = tables.written(whole_sets(long.select("node").distinct(), classes, docs, text, k), "crowd-sets")
        while True:
            found, lists, used = crowd_level(long, whole, counts, tables)
            links.append(tables.written(found.distinct(), "crowd-links"))
            entries = tables.written(counted(lists.distinct()), "lists")
            dense = tables.written(dense_lists(used, entries), "dense")
            if not dense.isEmpty():
                links.append(tables.written(block_links(used, dense).distinct(), "block-links"))
                entries = tables.written(lookup_join(entries, dense.select(F.col("list").alias("parent")), ["parent"], "left_anti"), "lists")
            tables.remove(used)
            pairs.append(short_pairs(entries.where(F.col("length") <= short)))
            long = entries.where(F.col("length") > short)
            if long.isEmpty():
                break
        tables.remove(whole)
    met = tables.written(reduce(DataFrame.union, pairs).distinct(), "pairs")
    tables.remove()
    met = _sides(met, classes, "n", "sketch").select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b")
    judged = met.mapInArrow(partial(_estimated, k=k), "a BIGINT, b BIGINT, exact BOOLEAN, maybe BOOLEAN").where("exact or maybe")
    judged = tables.written(judged, "estimated")
    tables.remove()
    maybe = judged.where("maybe").select("a", "b")
    whole = tables.written(whole_sets(maybe.select(F.explode(F.array("a", "b")).alias("node")).distinct(), classes, docs, text, k), "whole-sets")
    confirmed = _sides(maybe, whole, "values").select("a", "b", "values_a", "values_b").mapInArrow(_confirmed, "a BIGINT, b BIGINT")
    return reduce(DataFrame.union, [judged.where("exact").select("a", "b"), confirmed, *links])


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, short: int = SHORT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    spark = ready(docs.sparkSession)
    with Tables(spark, "minhash") as tables:
        found = tables.written(sketched(docs, doc_id, text, k), "sketches")
        classes = found.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("low"), F.any_value("n").alias("n"), F.min("at").alias("at"), F.any_value("sketch").alias("sketch"))
        classes = tables.written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
        rows = tables.written(found.select("doc_id", "n", "digest"), "rows")
        tables.remove(found)
        labels = components(class_links(classes, docs, tables, text, k, short), tables)
        named = lookup_join(classes.select("digest", "node", "low"), labels, ["node"]).withColumn("label", F.coalesce("label", "node"))
        lowest = named.groupBy("label").agg(F.min("low").alias("component_id"))
        groups = lookup_join(named.select("digest", "label"), lowest, ["label"], "inner").select("digest", "component_id")
        rows = lookup_join(rows, groups, ["digest"])
        component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        rows = rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
        return tables.result(rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))
