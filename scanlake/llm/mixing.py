"""Mixing sources to target weights by subset sums over document lengths.

Sources in code-point order (null last) weigh 1, 2, 3, repeating, and share all words. A
target stops at ``MOST`` times the source's size; the excess is shared again by weight
until no target is above. A source takes each document target // size times; the words
that are left are a subset-sum problem. Documents of one length are alike for it, so it
is solved on counts by exact length, one task per source: most of the budget is met in
proportion, and bounded-knapsack dynamic programming over the remaining counts finds the
reachable sum nearest to the rest (all of it when the source is small). The documents of
a length are picked by the smallest seeded hashes.

No group of documents meets in one task: equal hashes are folded to counts, the threshold
hash of a (source, length) is found through counts of about sqrt(n) hash buckets and a
ranking of the hashes inside one bucket. The hash is over all columns, so rows that share it
are equal and it makes no difference which of them are taken: where only some fit, that
many are taken, dealt out over the tasks they lie in.

Defined cases: a null text has size 0; null is a source of its own; a document of size 0
takes 0; repeated rows, and rows without an id, count singly; an empty table gives an empty
result; clashing columns are kept, as the operator's own columns get names that are free.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scanlake.llm.common import WORD, free_name, ready, written
from scanlake.operators.joins import lookup_join

#: Times that a document may be taken at most, and weights in turn.
MOST = 3
WEIGHTS = (1, 2, 3)
SEED = 7
#: Words that the dynamic programming covers exactly.
DP_WORDS = 1 << 16


def fit(lengths: list[int], counts: list[int], budget: int, dp_words: int = DP_WORDS) -> list[int]:
    """How many documents of each length to take so that the words come nearest to budget.

    Of two sums as near, the smaller. Exact if the source has up to ``dp_words`` words.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget <= 0 or total == 0:
        return [0] * len(lengths)
    if budget >= total:
        return list(counts)
    chosen = [0] * len(lengths)
    rest = budget
    if total > dp_words:
        chosen = [c * budget // total for c in counts]
        rest -= sum(n * c for n, c in zip(lengths, chosen))
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            if lengths[i] and rest > dp_words:
                more = min(counts[i] - chosen[i], (rest - dp_words) // lengths[i])
                chosen[i] += more
                rest -= more * lengths[i]
    # A sum beyond twice the rest is farther away than nothing at all.
    room = 2 * rest
    items: list[tuple[int, int]] = []  # index of the length, how many at once
    for i in sorted(range(len(lengths)), key=lambda i: lengths[i]):
        left, step = (min(counts[i] - chosen[i], room // lengths[i]) if lengths[i] else 0), 1
        while left:
            step = min(step, left)
            items.append((i, step))
            left, step = left - step, 2 * step
    reached, mask = 1, (1 << (room + 1)) - 1
    via = np.full(room + 1, -1, np.int32)  # the item that first reached a sum
    for at, (i, step) in enumerate(items):
        new = (reached << lengths[i] * step) & mask & ~reached
        if new:
            bits = np.unpackbits(np.frombuffer(new.to_bytes(room // 8 + 1, "little"), np.uint8), bitorder="little")
            via[np.flatnonzero(bits)] = at
            reached |= new
            if via[rest] >= 0:
                break
    sums = np.flatnonzero(via >= 0)
    best = min([0, *sums.tolist()], key=lambda s: (abs(s - rest), s))
    while best:
        i, step = items[via[best]]
        chosen[i] += step
        best -= lengths[i] * step
    return chosen


def _plan_source(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows (key, size, n, budget, source_size) of one source to (key, size, n, whole, extra)."""
    rows = rows.sort_values("size")
    lengths, counts = [int(x) for x in rows["size"]], [int(x) for x in rows["n"]]
    budget, total = int(rows["budget"].iloc[0]), int(rows["source_size"].iloc[0])
    whole = budget // total if total else 0
    extra = fit(lengths, counts, budget - whole * total)
    return pd.DataFrame({"key": rows["key"], "size": rows["size"], "n": rows["n"], "whole": whole, "extra": extra})


def _ranked(totals: DataFrame) -> DataFrame:
    """Sources with their place in code-point order, without one task sorting them all."""
    ordered = totals.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id())
    ordered = written(ordered, "sources")
    part = F.shiftright("at", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows")).orderBy("part").collect()  # one row per shuffle partition
    starts, start = [], 0
    for row in counts:
        starts.append((row["part"], start))
        start += row["rows"]
    offsets = totals.sparkSession.createDataFrame(starts, "part BIGINT, start BIGINT")
    place = F.col("start") + F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("part", part).join(F.broadcast(offsets), "part").withColumn("place", place).drop("part", "start", "at")


def targets(totals: DataFrame) -> DataFrame:
    """key, source_size, target and budget (the target in whole words) of each source.

    totals has a row per source: key, source, source_size. A round settles every source
    whose share is above its limit; the driver sees three sums per round.
    """
    sources = _ranked(totals)
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("place") % len(WEIGHTS) + 1).cast("int")).cast("bigint")
    sources = written(sources.select("key", "source_size", weight.alias("weight"), (MOST * F.col("source_size")).alias("most")), "weights")
    words, weights, settled = sources.agg(F.sum("source_size"), F.sum("weight"), F.lit(0)).first()
    left, open_weights = words or 0, weights or 1
    while True:
        above = F.col("weight") * F.lit(float(left)) / F.lit(float(open_weights)) >= F.col("most")
        count, most, held = sources.where(above).agg(F.count(F.lit(1)), F.sum("most"), F.sum("weight")).first()
        if count == settled or not words:
            break
        settled, left, open_weights = count, words - (most or 0), max(1, weights - (held or 0))
    share = F.col("weight") * F.lit(float(left)) / F.lit(float(open_weights))
    target = F.least(share, F.col("most").cast("double"))
    return sources.select("key", "source_size", target.alias("target"), F.floor(target + 0.5).cast("bigint").alias("budget"))


def _sized(docs: DataFrame, doc_id: str, text: str, source: str, seed: int):
    """key, source, size and hash as columns of docs; the key stands for the source, null too."""
    named = F.col(source).cast("string")
    hashed = [F.col(doc_id).cast("string"), *[F.col(f"`{c}`") for c, kind in docs.dtypes if c != doc_id and "map<" not in kind]]
    return {
        "key": F.coalesce(F.concat(F.lit("s"), named), F.lit("n")),
        "source": named,
        "size": F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint"),
        # 63 bits, never negative.
        "hash": F.shiftrightunsigned(F.xxhash64(F.lit(seed), *hashed), 1),
    }


def decisions(sized: DataFrame) -> DataFrame:
    """What is taken by key and size: source_size, target, whole, limit, tied and more.

    sized has a row per document: key, source, size, hash. A document is taken ``whole``
    times, and once more if its hash is at most the limit; of those whose hash is ``tied``,
    ``more`` are taken once more.
    """
    counts = sized.groupBy("key", "size").agg(F.first("source").alias("source"), F.count(F.lit(1)).alias("n"))
    counts = written(counts, "length-counts")
    totals = counts.groupBy("key").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("n")).alias("source_size"))
    aims = written(targets(totals), "targets")
    by_length = lookup_join(counts.drop("source"), aims.select("key", "source_size", "budget"), ["key"], "inner")
    plan = by_length.groupBy("key").applyInPandas(_plan_source, "key STRING, size BIGINT, n BIGINT, whole BIGINT, extra BIGINT")
    plan = written(plan, "mixing-plan")

    # Documents by leading hash bits, about sqrt(n) buckets, then one bucket's documents in order.
    some = plan.where("extra > 0 AND extra < n").select("key", "size", "extra", F.ceil(F.log2("n") / 2).cast("int").alias("bits"))
    split = lookup_join(sized.select("key", "size", "hash"), some, ["key", "size"], "inner")
    split = split.groupBy("key", "size", "hash", "bits", "extra").agg(F.count(F.lit(1)).alias("rows"))
    split = written(split.withColumn("bucket", F.expr("shiftright(hash, 63 - bits)")), "hash-counts")
    tally = split.groupBy("key", "size", "bits", "bucket").agg(F.sum("rows").alias("here"), F.first("extra").alias("extra"))
    upto = F.sum("here").over(Window.partitionBy("key", "size").orderBy("bucket"))
    edge = tally.withColumn("upto", upto).where("upto >= extra AND upto - here < extra")
    edge = edge.selectExpr("key", "size", "bucket", "extra - upto + here AS wanted", "shiftleft(bucket, 63 - bits) AS start")
    inside = lookup_join(split.select("key", "size", "bucket", "hash", "rows"), edge, ["key", "size", "bucket"], "inner")
    last = F.sum("rows").over(Window.partitionBy("key", "size").orderBy("hash"))
    inside = inside.withColumn("last", last)
    part = F.when((F.col("last") > F.col("wanted")) & (F.col("last") - F.col("rows") < F.col("wanted")), F.struct("hash", (F.col("wanted") - F.col("last") + F.col("rows")).alias("more")))
    fits = F.max(F.when(F.col("last") <= F.col("wanted"), F.col("hash")))
    limits = inside.groupBy("key", "size").agg(F.coalesce(fits, F.min("start") - 1).alias("edge"), F.max(part).alias("part"))
    limit = F.when(F.col("extra") == 0, F.lit(-1)).when(F.col("extra") == F.col("n"), F.lit((1 << 63) - 1)).otherwise(F.col("edge"))
    known = plan.join(limits, ["key", "size"], "left").select("key", "size", "whole", limit.alias("limit"), F.col("part.hash").alias("tied"), F.col("part.more").alias("more"))
    return lookup_join(known, aims.select("key", "source_size", "target"), ["key"], "inner")


def _allotted(key: str, size: str, part: str, rows: str, more: str) -> Column:
    """How many of a part's equal rows are taken once more: ``more`` in all, the first parts first."""
    upto = F.sum(rows).over(Window.partitionBy(key, size).orderBy(part))  # a part per task
    return F.greatest(F.lit(0), F.least(F.col(rows), F.col(more) - (upto - F.col(rows))))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken."""
    ready(docs.sparkSession)
    columns = _sized(docs, doc_id, text, source, seed)
    sized = docs.select(F.col(doc_id).alias("doc_id"), *[c.alias(n) for n, c in columns.items()])
    sized = written(sized, "document-sizes")  # texts are read once
    found = lookup_join(sized, decisions(sized), ["key", "size"], "inner")
    is_tied = F.coalesce(F.col("hash") == F.col("tied"), F.lit(False))
    plain = found.where(~is_tied).withColumn("copies", F.col("whole") + (F.col("hash") <= F.col("limit")).cast("bigint"))
    same = ["doc_id", "source", "key", "size", "source_size", "target", "whole", "more"]
    tied = found.where(is_tied).withColumn("part", F.spark_partition_id()).groupBy(*same, "part").agg(F.count(F.lit(1)).alias("rows"))
    tied = written(tied, "tied-rows")
    tied = tied.withColumn("also", _allotted("key", "size", "part", "rows", "more"))
    tied = tied.select("*", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("at"))
    tied = tied.withColumn("copies", F.col("whole") + (F.col("at") <= F.col("also")).cast("bigint"))
    columns = ["doc_id", "source", "size", "source_size", "target", "copies"]
    return plain.select(*columns).union(tied.select(*columns)).withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: int = SEED) -> DataFrame:
    """The mix itself: the documents' columns, each row as often as it is taken."""
    ready(docs.sparkSession)
    columns = {free_name(docs.columns, n): c for n, c in _sized(docs, doc_id, text, source, seed).items()}
    key, named, size, hashed = columns
    rows = docs.withColumns(columns)
    sized = written(rows.select(F.col(key).alias("key"), F.col(named).alias("source"), F.col(size).alias("size"), F.col(hashed).alias("hash")), "document-sizes")
    known = decisions(sized).where("whole > 0 OR limit >= 0 OR more > 0").selectExpr("key k", "size s", "whole w", "limit l", "tied t", "more m")
    known = known.toDF(*[free_name(rows.columns, n) for n in ("key", "size", "whole", "limit", "tied", "more")])
    k, s, whole, limit, tied, more = known.columns
    found = lookup_join(rows, known.withColumnsRenamed({k: key, s: size}), [key, size], "inner").where(F.col(size) > 0)
    is_tied = F.coalesce(F.col(hashed) == F.col(tied), F.lit(False))
    copies = F.col(whole) + (F.col(hashed) <= F.col(limit)).cast("bigint")
    again = lambda n: F.explode(F.sequence(F.lit(1).cast("bigint"), n))
    copy = free_name(docs.columns, "copy")
    plain = found.where(~is_tied).where(copies > 0).select(*docs.columns, again(copies).alias(copy)).select(*docs.columns)
    # Equal rows: one of each task stands for its others.
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    parts = found.where(is_tied).select(F.col(key).alias("key"), F.col(size).alias("size"), F.col(whole).alias("whole"), F.col(more).alias("more"), row.alias("row"))
    parts = parts.withColumn("part", F.spark_partition_id()).groupBy("key", "size", "whole", "more", "part").agg(F.first("row").alias("row"), F.count(F.lit(1)).alias("rows"))
    parts = written(parts, "tied-rows")
    times = F.col("whole") * F.col("rows") + _allotted("key", "size", "part", "rows", "more")
    parts = parts.withColumn("times", times).where("times > 0").select("row", again(F.col("times")).alias("copy"))
    return plain.union(parts.select("row.*"))
