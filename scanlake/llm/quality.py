"""Quality by importance resampling: target and raw text as hashed n-gram models.

Bytes in runs of 3 and of 5 (digits folded to 0) are hashed to ``BUCKETS`` buckets. The
raw model counts them over all documents, the target model over documents labelled good.
A document's log weight is the sum of log(target / raw) over its n-grams. Documents are
drawn without replacement with probabilities in proportion to the weights: a Gumbel
variable, seeded by the document id, is added and the k largest stay.

k is the number of documents whose weight is at least that of all but ``1 - KEEP_TARGET``
of the labelled good ones, so the draw drops what the target model cannot explain; for
documents near the limit the draw decides.

Defined cases: a null or very short text has weight 0 (no evidence); a null doc_id draws
like any other id; rows with one id and text share their fate, ties at the limit stay;
without labelled good documents all stay; an empty table gives an empty result; clashing
columns are kept, labels may repeat an id (the lowest quality counts).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import free_name, ready, written

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
RUNS = (3, 5)
#: Labelled good documents used at most: of so many hash buckets the smallest one each.
MAX_LABELLED = 50_000
KEEP_TARGET = 0.995
SEED = 11
#: Fixed point of ranked weights, and bits of a rank.
SCALE, RANK_BITS, STEP_BITS = 1 << 16, 52, 13

_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("0") : ord("9") + 1] = ord("0")
_STEP, _SPREAD = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)


def buckets(text: str | None) -> list[np.ndarray]:
    """Buckets of the n-grams of a text, an array per length of run."""
    data = _FOLD[np.frombuffer((text or "").encode(), np.uint8)].astype(np.uint64)
    found, state = [], np.zeros(len(data), np.uint64)
    for n in range(1, max(RUNS) + 1):
        size = len(data) - n + 1
        if size <= 0:
            break
        state = state[:size] * _STEP ^ data[n - 1 :]
        if n in RUNS:
            found.append(((state + np.uint64(n)) * _SPREAD >> np.uint64(64 - BUCKET_BITS)).astype(np.int64))
    return found


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for text, good in zip(batch.column(0), batch.column(1).to_pylist()):
            for found in buckets(text.as_py()):
                counts = np.bincount(found, minlength=BUCKETS)
                raw += counts
                if good:
                    target += counts
    used = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(raw[used]), pa.array(target[used])], names=["bucket", "raw", "target"])


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(target / raw) by bucket; the target model is drawn towards the raw one."""
    if not target.sum():
        return np.zeros(BUCKETS)
    base = (raw + 1) / (raw.sum() + BUCKETS)
    weight = BUCKETS / 4
    return np.log((target + weight * base) / (target.sum() + weight) / base)


def labelled_good(labels: DataFrame, most: int = MAX_LABELLED) -> DataFrame:
    """At most ``most`` ids whose lowest quality label is 1."""
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    hashed = F.xxhash64("doc_id")
    good = known.where("quality = 1").groupBy(F.pmod(hashed, F.lit(most)).alias("bucket"))
    return good.agg(F.min(F.struct(hashed.alias("h"), F.col("doc_id").cast("bigint").alias("id"))).alias("one")).select(F.col("one.id").alias("good_id"))


def weight_column(spark, ratios: np.ndarray, text: Column) -> Column:
    """Log weight of a text. The model is 2**BUCKET_BITS numbers, whatever the input."""
    shared = spark.sparkContext.broadcast(ratios)

    @F.arrow_udf("double")
    def weigh(texts: pa.Array) -> pa.Array:
        table = shared.value
        return pa.array([sum(float(table[found].sum()) for found in buckets(t.as_py())) / len(RUNS) for t in texts], pa.float64())

    return weigh(text)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """A standard Gumbel variable fixed by the id and the seed."""
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), doc_id.cast("string")), 12).cast("double") + 0.5) / float(1 << 52)
    return -F.log(-F.log(uniform))


def kth_largest(ranks: DataFrame, k: int) -> int:
    """The k-th largest of column ``rank`` (RANK_BITS bits), by counts of leading bits.

    Each pass counts the values that share the bits found so far by their next STEP_BITS
    bits, so the driver sees 2**STEP_BITS rows at most.
    """
    prefix, left = 0, k
    for shift in range(RANK_BITS - STEP_BITS, -1, -STEP_BITS):
        inside = ranks.where(F.shiftright("rank", shift + STEP_BITS) == prefix)
        counts = inside.groupBy(F.shiftright("rank", shift).alias("head")).agg(F.count(F.lit(1)).alias("n")).collect()
        for head, n in sorted((tuple(row) for row in counts), reverse=True):
            if left <= n:
                prefix = head
                break
            left -= n
    return prefix


def resampled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: bool = True) -> tuple[DataFrame, str, str, str]:
    """Documents with log weight, perturbed weight and whether they stay, as a frame.

    Returns the frame and the names of the three columns, which are free in docs. With
    ``carry`` all columns of docs are there, otherwise only the id.
    """
    spark = ready(docs.sparkSession)
    good_id = free_name(docs.columns, "good_id")
    good = F.broadcast(labelled_good(labels).toDF(good_id))  # MAX_LABELLED rows at most
    weight, drawn, stays, flag = (free_name(docs.columns, n) for n in ("log_weight", "drawn_weight", "selected", "labelled_good"))
    marked = docs.join(good, docs[doc_id].cast("bigint") == good[good_id], "left")
    marked = marked.withColumn(flag, F.col(good_id).isNotNull()).drop(good_id)
    counts = marked.select(F.col(text).cast("string"), flag).mapInArrow(_count, "bucket BIGINT, raw BIGINT, target BIGINT")
    raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for bucket, r, t in counts.groupBy("bucket").agg(F.sum("raw"), F.sum("target")).collect():  # BUCKETS rows at most
        raw[bucket], target[bucket] = r, t
    kept = docs.columns if carry else [doc_id]
    scored = marked.withColumn(weight, weight_column(spark, log_ratios(raw, target), F.col(text).cast("string")))
    scored = written(scored.select(*kept, flag, weight), "weights")
    perturbed = F.col(weight) + gumbel(F.col(doc_id))
    top = (1 << (RANK_BITS - 1)) - 1
    rank = F.least(F.greatest(F.round(perturbed * SCALE).cast("bigint"), F.lit(-top)), F.lit(top)) + top
    least = scored.where(flag).agg(F.percentile(weight, F.lit(1 - KEEP_TARGET))).first()[0]
    enough = F.lit(True) if least is None else F.col(weight) >= F.lit(least)
    k = scored.where(enough).count()
    limit = kth_largest(scored.select(rank.alias("rank")), k) if k else 0
    found = scored.withColumn(drawn, perturbed).withColumn(stays, rank >= limit if k else F.lit(False)).drop(flag)
    return found, weight, drawn, stays


def good_documents(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that stay, with their columns."""
    found, _, _, stays = resampled(docs, labels, doc_id, text)
    return found.where(F.col(stays)).select(*docs.columns)
