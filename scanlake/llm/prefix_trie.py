"""Trie of rebuilt conversations by whole-sequence collapse.

A conversation c is rebuilt from the first h turns of its base (c - c % ``BLOCK``) and its
own turns after its first h. Its prefixes are nodes of a trie below a textless root.

Prefixes are told apart by their length and two composable hashes modulo 2**61 - 1 of
(role, text): the hash of a sequence follows from those of its parts, so that turns are
sorted by range and hashed as a stream, each task keeping only a running state, and a
conversation that holds a third of all turns is cut over many tasks like any other. Two
different prefixes of one length d share both hashes with probability below (d / 2**61)**2.

1. Identical rebuilt conversations collapse to one weighted sequence, named by its
   smallest conv_id, with the list of conv_ids that end there.
2. Sequences that are proper prefixes of others are dropped by an anti-join of whole
   sequences against proper prefixes; what is left are the leaves.
3. Prefixes of weighted sequences, each carrying its weight and whether it leads to a
   leaf, are aggregated into nodes.

Sums over subtrees need no walk by depth. The members' texts from a node downwards sum to
(total text) - (text above the node), weighted. The distinct nodes below are counted once
by giving each to the sequence of its smallest member: those of one sequence are a suffix
of it, so a running sum tells how much text a sequence owns below any of its prefixes.

Lists of ends are joined to text by chunks of 2**``CHUNK`` ids each; the digest of a
node's list then streams over its few chunks in order, holding one at a time. A digest has
one order, so a node's chunks pass through one task, as bytes that are already joined.

Defined cases: a null conv_id names no conversation, such rows take no part; a null turn
comes first, equal turns are ordered by role and text; null role and text are empty;
repeated rows are repeated turns; a negative conv_id has its base towards zero; a
conversation without a turn ends at the root; an empty table gives no node; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import ready
from scanlake.llm.tables import Tables
from scanlake.operators.joins import lookup_join

PRIME = (1 << 61) - 1
#: Bases of the two hashes, any two large numbers below PRIME.
BASES = (0x1F3D5B79A2C4E687 % PRIME, 0x0A1B2C3D4E5F6977 % PRIME)
#: conv_ids of one block share a base; at most HEADS turns are taken from it.
BLOCK, HEADS = 100, 5
CHUNK = 16

KEY = ["depth", "h1", "h2"]
#: Place, text length, text length up to here, hashes before (p) and after the turn (h).
_TURN = "conv_id BIGINT, at BIGINT, chars BIGINT, upto BIGINT, p1 BIGINT, p2 BIGINT, h1 BIGINT, h2 BIGINT"
_NAMES = [field.split()[0] for field in _TURN.split(", ")]


def turn_values(role: str, text: str) -> tuple[int, int]:
    """Two numbers below PRIME for a turn; the length of the role keeps its border."""
    data = role.encode()
    digest = hashlib.blake2b(len(data).to_bytes(8, "little") + data + text.encode(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little") % PRIME, int.from_bytes(digest[8:], "little") % PRIME


def _hash_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns to places, text lengths and running hashes since the task's first turn of each conversation."""
    conv, at, upto, h1, h2 = None, 0, 0, 0, 0
    for batch in batches:
        out = []
        for c, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if c != conv:
                conv, at, upto, h1, h2 = c, 0, 0, 0, 0
            t1, t2 = turn_values(role, text)
            at, upto, p1, p2 = at + 1, upto + len(text), h1, h2
            h1, h2 = (h1 * BASES[0] + t1) % PRIME, (h2 * BASES[1] + t2) % PRIME
            out.append((c, at, len(text), upto, p1, p2, h1, h2))
        columns = zip(*out) if out else [[] for _ in _NAMES]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=_NAMES)


def joined_hash(head: int, tail: int, length: int, base: int) -> int:
    """Hash of a sequence from those of its head and of its tail of that length."""
    return (head * pow(base, length, PRIME) + tail) % PRIME


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of each conversation (in task order, as lists) to the state before each."""
    for batch in batches:
        out = []
        for c, segments in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            at, upto, h1, h2 = 0, 0, 0, 0
            for s in segments:
                out.append((c, s["task"], at, upto, h1, h2))
                h1, h2 = joined_hash(h1, s["h1"], s["at"], BASES[0]), joined_hash(h2, s["h2"], s["at"], BASES[1])
                at, upto = at + s["at"], upto + s["upto"]
        columns = zip(*out) if out else [[] for _ in range(6)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["conv_id", "task", "at0", "upto0", "g1", "g2"])


def _continue(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns with the state before their segment to turns counted and hashed from the conversation's start."""
    for batch in batches:
        get = dict(zip(batch.schema.names, (c.to_pylist() for c in batch.columns)))
        hashes = [
            pa.array([joined_hash(g, h, n - early, base) for g, h, n in zip(get[f"g{i}"], get[f"{k}{i}"], get["at"])], pa.int64())
            for k, early in (("p", 1), ("h", 0))
            for i, base in enumerate(BASES, 1)
        ]
        shift = lambda a, b: pa.array(np.array(get[a], np.int64) + np.array(get[b], np.int64))
        values = [batch.column("conv_id"), shift("at", "at0"), batch.column("chars"), shift("upto", "upto0"), *hashes]
        yield pa.RecordBatch.from_arrays(values, names=_NAMES)


def hashed_turns(conversations: DataFrame, tables: Tables, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Every turn with its place, and hash and text length of the conversation up to it."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    named = conversations.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).alias("turn"), empty(role).alias("role"), empty(text).alias("text"))
    # Rows equal in all else are dealt out by a number of their own; any order of them is the same.
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text"), F.col("copy")]
    rows = named.where("conv_id IS NOT NULL").withColumn("copy", F.monotonically_increasing_id())
    arranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("conv_id", "role", "text")
    local = tables.written(arranged.mapInArrow(_hash_turns, _TURN).withColumn("task", F.spark_partition_id().cast("bigint")), "turns-by-task")
    # A row per conversation and task; lists are as long as there are tasks at most.
    last = F.max(F.struct("at", "upto", "h1", "h2")).alias("s")
    segments = local.groupBy("conv_id", "task").agg(last).select("conv_id", F.struct("task", "s.*").alias("s"))
    lists = segments.groupBy("conv_id").agg(F.array_sort(F.collect_list("s")).alias("segments"))
    starts = lists.mapInArrow(_starts, "conv_id BIGINT, task BIGINT, at0 BIGINT, upto0 BIGINT, g1 BIGINT, g2 BIGINT")
    whole = lookup_join(local, starts, ["conv_id", "task"], "inner").drop("task").mapInArrow(_continue, _TURN)
    return tables.written(whole, "turns")


_FIELDS = _NAMES[1:]
_STATE = "STRUCT<" + ", ".join(f"{n}: BIGINT" for n in _FIELDS) + ">"


def rebuilt(turns: DataFrame) -> DataFrame:
    """A row per conversation: from where its turns come, and the state at both cuts.

    ``above``: the turns of the base, HEADS at most; ``cut``: its own state after the
    first h turns; ``n`` its own number of turns; ``last``: its own last state.
    """
    base = F.col("conv_id") - F.col("conv_id") % BLOCK
    taken = F.crc32(F.col("conv_id").cast("string").cast("binary")) % (HEADS + 1)
    state = F.struct(*_FIELDS)
    own = turns.groupBy("conv_id").agg(
        F.max("at").alias("n"),
        F.max(state).alias("last"),
        F.array_sort(F.collect_list(F.when(F.col("at") <= HEADS, state))).alias("first"),  # HEADS at most
    )
    own = own.withColumns({"base": base, "h": taken})
    bases = own.where("conv_id = base").select(F.col("conv_id").alias("base"), F.col("first").alias("above"))
    known = lookup_join(own, bases, ["base"]).withColumn("above", F.slice(F.coalesce("above", F.array().cast(f"ARRAY<{_STATE}>")), 1, F.col("h").cast("int")))
    start = F.lit(None).cast(_STATE)
    cut = F.when(F.col("h") > 0, F.try_element_at("first", F.least("h", "n").cast("int"))).otherwise(start)
    return known.select("conv_id", "n", "h", "last", "above", cut.alias("cut"))


def _moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Own turns after the cut to their hashes in the rebuilt conversation."""
    for batch in batches:
        get = dict(zip(batch.schema.names, (c.to_pylist() for c in batch.columns)))
        for i, base in enumerate(BASES, 1):
            # The own prefix up to the cut is exchanged for that of the base.
            for k, early in (("p", 1), ("h", 0)):
                get[f"{k}{i}"] = [(h + (b - c) * pow(base, n - early, PRIME)) % PRIME for h, b, c, n in zip(get[f"{k}{i}"], get[f"b{i}"], get[f"c{i}"], get["after"])]
        get["depth"] = [a + b for a, b in zip(get["after"], get["b_at"])]
        get["upto"] = [u + b - c for u, b, c in zip(get["upto"], get["b_upto"], get["c_upto"])]
        yield pa.RecordBatch.from_arrays([pa.array(get[n], pa.int64()) for n in _PREFIX_NAMES], names=_PREFIX_NAMES)


_PREFIX = "conv_id BIGINT, depth BIGINT, chars BIGINT, upto BIGINT, p1 BIGINT, p2 BIGINT, h1 BIGINT, h2 BIGINT"
_PREFIX_NAMES = [field.split()[0] for field in _PREFIX.split(", ")]


def moved(rows: DataFrame) -> DataFrame:
    """Rows with a conversation's ``above`` and ``cut`` and one of its own states, in the rebuilt conversation."""
    of = lambda c, name: F.coalesce(F.col(f"{c}.{name}"), F.lit(0))
    held = rows.withColumn("base_end", F.try_element_at("above", F.lit(-1)))
    states = [of(c, n).alias(f"{k}{m}") for c, k in (("base_end", "b"), ("cut", "c")) for n, m in (("h1", "1"), ("h2", "2"), ("upto", "_upto"), ("at", "_at"))]
    after = (F.col("at") - F.col("h")).alias("after")
    return held.select("conv_id", after, *_FIELDS[1:], *states).mapInArrow(_moved, _PREFIX)


def ends(rows: DataFrame) -> DataFrame:
    """The final prefix of every conversation: its own last turn, or the end of what it takes from the base."""
    own = moved(rows.where("n > h").select("conv_id", "h", "above", "cut", "last.*"))
    end = F.try_element_at("above", F.lit(-1))
    of = lambda n: F.coalesce(end[n], F.lit(0).cast("bigint")).alias(n)
    taken = rows.where("n <= h").select("conv_id", of("at").alias("depth"), *map(of, _FIELDS[1:]))
    return own.unionByName(taken)


def prefixes(turns: DataFrame, rows: DataFrame) -> DataFrame:
    """Every prefix of the rebuilt conversations in ``rows``, the root included."""
    root = F.struct(*[F.lit(0).cast("bigint").alias(n) for n in _FIELDS])
    taken = rows.select("conv_id", F.explode(F.concat(F.array(root), "above")).alias("s"))
    taken = taken.select("conv_id", F.col("s.at").alias("depth"), *[F.col(f"s.{n}").alias(n) for n in _FIELDS[1:]])
    own = lookup_join(turns, rows.select("conv_id", "h", "above", "cut"), ["conv_id"], "inner").where("at > h")
    return taken.unionByName(moved(own))


def _digest_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of id lists, sorted by node and chunk, to a digest per node; one chunk is held at a time."""
    key, digest = None, None
    names = [*KEY, "ends_sha256"]
    for batch in batches:
        out = []
        for *k, ids in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if k == key:
                digest.update(b"," + ids.encode())
            else:
                if key is not None:
                    out.append((*key, digest.hexdigest()))
                key, digest = k, hashlib.sha256(ids.encode())
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, o)) for o in out])
    if key is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, digest.hexdigest())))])


def end_digests(finals: DataFrame) -> DataFrame:
    """By node the SHA-256 of the conv_ids that end there, ascending, joined by commas."""
    chunk = F.shiftright("conv_id", CHUNK).alias("chunk")
    lists = finals.groupBy(*KEY, chunk).agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))  # 2**CHUNK at most
    joined = lists.select(*KEY, "chunk", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    arranged = joined.repartition(*KEY).sortWithinPartitions(*KEY, "chunk").select(*KEY, "ids")
    return arranged.mapInArrow(_digest_lists, "depth BIGINT, h1 BIGINT, h2 BIGINT, ends_sha256 STRING")


def trie(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    spark = ready(conversations.sparkSession)
    with Tables(spark, "trie") as tables:
        turns = hashed_turns(conversations, tables, conv_id, turn, role, text)
        rows = tables.written(rebuilt(turns), "rebuilt")
        finals = tables.written(ends(rows).select("conv_id", *KEY, F.col("upto").alias("total")), "ends")
        # Whole-sequence collapse: one weighted sequence of each set of identical conversations.
        sequences = finals.groupBy(*KEY).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("conv_id"), F.any_value("total").alias("total"))
        sequences = tables.written(sequences, "sequences")
        named = sequences.select("conv_id", "weight", "total", F.col("depth").alias("length"))
        found = lookup_join(prefixes(turns, lookup_join(rows, named.select("conv_id"), ["conv_id"], "left_semi")), named, ["conv_id"], "inner")
        found = tables.written(found, "prefixes")
        # Of the sequences those that are no proper prefix of another: the leaves.
        inner = found.where("depth < length").groupBy(*KEY).agg(F.lit(True).alias("inner"))
        leaves = lookup_join(sequences, inner, KEY, "left_anti").select("conv_id", F.lit(1).alias("leaf"))
        weighted = lookup_join(found, leaves, ["conv_id"])
        nodes = weighted.groupBy(*KEY).agg(
            F.min("conv_id").alias("conv_id"),
            F.sum("weight").alias("n_convs"),
            F.count("leaf").alias("n_leaves"),
            F.any_value(F.struct("p1", "p2", "chars", "upto")).alias("last"),
            F.sum(F.col("weight") * F.col("total")).alias("texts"),
        )
        above = F.struct((F.col("depth") - 1).alias("depth"), F.col("last.p1").alias("h1"), F.col("last.p2").alias("h2"))
        start = F.col("last.upto") - F.col("last.chars")
        nodes = tables.written(nodes.select(*KEY, "conv_id", "n_convs", "n_leaves", (F.col("texts") - F.col("n_convs") * start).alias("texts"), start.alias("start"), F.when(F.col("depth") > 0, above).alias("above")), "nodes")
        # What a sequence owns begins where its first own node does.
        owned = nodes.groupBy("conv_id").agg(F.min("start").alias("own_from"))
        below = lookup_join(found, owned, ["conv_id"], "inner")
        below = below.select(*KEY, (F.col("total") - F.greatest(F.col("upto") - F.col("chars"), "own_from")).alias("once"))
        none = lambda t: F.lit(None).cast(t)
        parts = nodes.select(*KEY, "conv_id", "n_convs", "n_leaves", "texts", "above", none("bigint").alias("child"), none("bigint").alias("once"), none("string").alias("ends_sha256"))
        parts = parts.unionByName(nodes.where("depth > 0").select("above.*", F.lit(1).cast("bigint").alias("child")), allowMissingColumns=True)
        parts = parts.unionByName(below, allowMissingColumns=True).unionByName(end_digests(finals), allowMissingColumns=True)
        summed = parts.groupBy(*KEY).agg(
            *[F.max(c).alias(c) for c in ("conv_id", "n_convs", "n_leaves", "texts", "above", "ends_sha256")],
            F.count("child").alias("n_children"),
            F.coalesce(F.sum("once"), F.lit(0)).alias("once"),
        )
        parents = nodes.select(F.struct(*KEY).alias("above"), F.col("conv_id").alias("parent_conv_id"))
        named = lookup_join(summed, parents, ["above"])
        return tables.result(
            named.select(
                "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                (F.col("texts") - F.col("once")).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
            )
        )
