"""Exact duplicates through an extendible-hash index in the shared folder.

Three steps:

1. *Pages.* Each task folds the equal texts it reads into one entry (text, the ids that
   have it). A task holds at most ``PAGE_BYTES`` of text, then starts afresh, so a group
   with a third of all rows is many small entries, one per page.
2. *Directory.* The key is 64 bits of a hash. Entry sizes are counted by leading key
   bits; the directory starts with one bucket and doubles while a bucket is overfull:
   such a bucket splits by its next bit. Capacity grows with the data so that the
   directory has at most 2**MAX_DEPTH entries (its proven size bound).
3. *Owners.* Each bucket is a key range with one owner task, which reads its entries in
   the order (key, largest id first) and compares bytes with the chain of texts that
   share the key. The first entry of a text therefore has the id that stays.

The index (key, chain position, hash, id that stays, ids of the entry) is a table in the
shared folder. Only one text per page and distinct text is shuffled.

Defined cases: a null text counts as empty; a null doc_id is smaller than any other; of
rows with the same text and doc_id one is kept; an empty table gives an empty result;
other columns are carried along or ignored, their names never clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scanlake.llm.common import ready, written
from scanlake.operators.joins import lookup_join

#: Text that a task folds before it starts afresh.
PAGE_BYTES = 32 << 20
#: Bits of the largest directory, and the smallest capacity of a bucket in bytes of text.
MAX_DEPTH = 16
BUCKET_BYTES = 4 << 20

ENTRY = "entry STRING, key BIGINT, size BIGINT, top_id BIGINT, ids ARRAY<BIGINT>"
MEMBER = "entry STRING, bucket INT, key BIGINT, chain INT, sha STRING, keep_id BIGINT, first BOOLEAN, ids ARRAY<BIGINT>"
LEAD = 6  # columns of a placed entry before the document's own


def normalised(text: str | None) -> bytes:
    """UTF-8 with A-Z in lower case; bytes.lower changes no other byte."""
    return (text or "").encode().lower()


def hash_key(data: bytes) -> int:
    """64 bits of SHA-256 as a signed number."""
    return int.from_bytes(hashlib.sha256(data).digest()[:8], "big", signed=True)


def _order(doc_id: int | None) -> tuple[bool, int]:
    return (doc_id is not None, doc_id or 0)


class Pages:
    """Folds rows (doc_id, text, other columns) into entries.

    ``key_of`` is a parameter so that tests can force collisions.
    """

    def __init__(self, key_of):
        self.key_of = key_of

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, page, held = TaskContext.get().partitionId(), 0, 0
        found: dict[bytes, list] = {}
        kinds: list[pa.Field] = []
        for batch in batches:
            kinds = list(batch.schema)[1:]
            ids, *columns = (column.to_pylist() for column in batch.columns)
            for doc_id, row in zip(ids, zip(*columns)):
                data = normalised(row[0])
                got = found.get(data)
                if got is None:
                    found[data] = [doc_id, [doc_id], row]
                    held += 2 * len(data) + 500
                else:
                    got[1].append(doc_id)
                    if _order(doc_id) > _order(got[0]):
                        got[0], got[2] = doc_id, row
                    held += 40
                if held > PAGE_BYTES:
                    yield from self._flush(found, kinds, f"{task}.{page}")
                    found, held, page = {}, 0, page + 1
        yield from self._flush(found, kinds, f"{task}.{page}")

    def _flush(self, found: dict, kinds: list[pa.Field], page: str) -> Iterator[pa.RecordBatch]:
        items = list(found.items())
        for start in range(0, len(items), 2000):
            part = items[start : start + 2000]
            columns = [
                pa.array([f"{page}.{start + i}" for i in range(len(part))], pa.string()),
                pa.array([self.key_of(data) for data, _ in part], pa.int64()),
                pa.array([len(data) for data, _ in part], pa.int64()),
                pa.array([got[0] for _, got in part], pa.int64()),
                pa.array([got[1] for _, got in part], pa.list_(pa.int64())),
            ]
            columns += [pa.array(c, k.type) for c, k in zip(zip(*(got[2] for _, got in part)), kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=["entry", "key", "size", "top_id", "ids"] + [k.name for k in kinds])


class Owners:
    """Walks the sorted entries of its key ranges and compares bytes along each chain."""

    def __init__(self, rows: bool):
        self.rows = rows  # give the documents that stay instead of the index

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, chain = None, []
        for batch in batches:
            out: list[tuple] = []
            staying: list[int] = []
            entries, buckets, keys, _, tops, ids, texts = (batch.column(i).to_pylist() for i in range(LEAD + 1))
            for row, text in enumerate(texts):
                data = normalised(text)
                if keys[row] != key:
                    key, chain = keys[row], []
                place = next((i for i, seen in enumerate(chain) if seen[0] == data), len(chain))
                first = place == len(chain)
                if first:
                    chain.append((data, hashlib.sha256(data).hexdigest(), tops[row]))
                    staying.append(row)
                _, sha, keep = chain[place]
                out.append((entries[row], buckets[row], key, place, sha, keep, first, ids[row]))
            if self.rows:
                yield batch.select(batch.schema.names[4:5] + batch.schema.names[LEAD:]).take(pa.array(staying, pa.int64()))
            elif out:
                yield _index_batch(out)


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.int64())]
    names = [field.split()[0] for field in MEMBER.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def directory(sizes: dict[int, int], max_depth: int, capacity: int) -> list[int]:
    """Bucket of each value of the leading ``depth`` bits; its length is 2**depth.

    ``sizes`` has the bytes by the leading ``max_depth`` bits. Starting from one bucket,
    every overfull bucket is split by the next bit, doubling the directory if the bucket
    is already as deep as it is.
    """
    by_prefix = np.zeros(1 << max_depth, np.int64)
    for prefix, size in sizes.items():
        by_prefix[prefix] = size
    slots, local, depth = [0], [0], 0  # slot -> bucket; bucket -> local depth
    queue = [0]
    first = {0: 0}  # bucket -> its first slot, in units of the deepest directory
    while queue:
        bucket = queue.pop()
        start, width = first[bucket], 1 << (max_depth - local[bucket])
        if local[bucket] == max_depth or by_prefix[start : start + width].sum() <= capacity:
            continue
        if local[bucket] == depth:
            slots, depth = [b for b in slots for _ in (0, 1)], depth + 1
        local[bucket] += 1
        local.append(local[bucket])
        new, half = len(local) - 1, width // 2
        first[new] = start + half
        step = 1 << (max_depth - depth)
        for slot in range((start + half) // step, (start + width) // step):
            slots[slot] = new
        queue += [bucket, new]
    # Buckets are numbered in key order, so that a run of buckets is a key range.
    order = {bucket: i for i, bucket in enumerate(dict.fromkeys(slots))}
    return [order[bucket] for bucket in slots]


def _placed(docs: DataFrame, doc_id: str, text: str, key_of, carry: bool) -> tuple[DataFrame, list[str]]:
    """Entries dealt to the owners of their buckets, sorted; and the columns they carry."""
    spark = ready(docs.sparkSession)
    lead = [docs.columns.index(doc_id), docs.columns.index(text)]
    order = lead + [i for i in range(len(docs.columns)) if i not in lead and carry]
    # Positions instead of names: no name of a document column can clash with ours.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]).select(*[f"c{i}" for i in order])
    plain = plain.withColumns({f"c{lead[0]}": F.col(f"c{lead[0]}").cast("bigint"), f"c{lead[1]}": F.col(f"c{lead[1]}").cast("string")})
    schema = T.StructType(T.StructType.fromDDL(ENTRY).fields + [T.StructField(f.name, f.dataType) for f in plain.schema.fields[1:]])
    entries = written(plain.mapInArrow(Pages(key_of), schema), "dedup-pages")
    prefix = F.shiftright(F.col("key"), 64 - MAX_DEPTH) + (1 << (MAX_DEPTH - 1))
    counted = entries.groupBy(prefix.alias("prefix")).agg(F.sum("size").alias("size"))
    sizes = {r["prefix"]: r["size"] for r in counted.collect()}  # 2**MAX_DEPTH rows at most
    slots = directory(sizes, MAX_DEPTH, max(BUCKET_BYTES, sum(sizes.values()) >> (MAX_DEPTH - 1)))
    width = (1 << MAX_DEPTH) // len(slots)
    table = spark.createDataFrame([(slot * width + i, bucket) for slot, bucket in enumerate(slots) for i in range(width)], "prefix BIGINT, bucket INT")
    placed = (
        entries.withColumn("prefix", prefix)
        .join(F.broadcast(table), "prefix")  # 2**MAX_DEPTH rows, whatever the input
        .select("entry", "bucket", "key", "size", "top_id", "ids", *plain.columns[1:])
        .repartition("bucket")
        .sortWithinPartitions("bucket", "key", F.desc_nulls_last("top_id"), "entry")
    )
    return placed, [docs.columns[i] for i in order]


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key_of=hash_key) -> DataFrame:
    """The index as a written table: one row per entry (see ``MEMBER``)."""
    placed, _ = _placed(docs, doc_id, text, key_of, carry=False)
    return written(placed.mapInArrow(Owners(rows=False), MEMBER), "dedup-index")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key_of=hash_key) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    index = build_index(docs, doc_id, text, key_of)
    # One row per page and text is summed; the ids stay where they are.
    sizes = index.groupBy("key", "chain").agg(F.sum(F.size("ids").cast("bigint")).alias("group_size"))
    # A keep_id of null means that all ids are null: the first of the first entry stays.
    keeper = F.when(F.col("first"), F.coalesce(F.array_position("ids", F.col("keep_id")), F.lit(1)) - 1)
    members = lookup_join(index, sizes, ["key", "chain"], "inner").select("*", keeper.alias("keeper"))
    return members.select(
        "keep_id", "group_size", "keeper", F.col("sha").alias("text_sha256"), F.posexplode("ids").alias("place", "doc_id")
    ).select("doc_id", "keep_id", "group_size", F.coalesce(F.col("place") == F.col("keeper"), F.lit(False)).alias("kept"), "text_sha256")


def drop_exact(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", key_of=hash_key) -> DataFrame:
    """The documents with all their columns, one row of each group of equal texts."""
    placed, names = _placed(docs, doc_id, text, key_of, carry=True)
    kinds = [placed.schema["top_id"], *placed.schema.fields[LEAD:]]
    kept = placed.mapInArrow(Owners(rows=True), T.StructType(kinds)).toDF(*[f"c{i}" for i in range(len(names))])
    back = [f"c{names.index(name)}" if docs.columns.count(name) == 1 else f"c{i}" for i, name in enumerate(docs.columns)]
    return kept.select(*back).toDF(*docs.columns)
