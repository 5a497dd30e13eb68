"""Importance resampling against a plain version, and against labels."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from scanlake.llm import quality

MASK = (1 << 64) - 1


def brute_buckets(text):
    data = ["0" if chr(b).isascii() and chr(b).isdigit() else b for b in (text or "").encode()]
    data = [ord(b) if isinstance(b, str) else b for b in data]
    for n in (3, 5):
        for i in range(len(data) - n + 1):
            state = 0
            for b in data[i : i + n]:
                state = state * 0x100000001B3 & MASK ^ b
            yield ((state + n) * 0x9E3779B97F4A7C15 & MASK) >> 48


def brute_weights(rows, good):
    """rows of (id, text) to log weights."""
    raw, target = Counter(), Counter()
    for doc_id, text in rows:
        found = Counter(brute_buckets(text))
        raw.update(found)
        if doc_id in good:
            target.update(found)
    total, wanted, pull = sum(raw.values()), sum(target.values()), 65536 / 4
    weights = []
    for _, text in rows:
        weight = 0.0
        for b in brute_buckets(text):
            base = (raw[b] + 1) / (total + 65536)
            weight += math.log((target[b] + pull * base) / (wanted + pull) / base) if wanted else 0.0
        weights.append(weight / 2)
    return weights


def labels_of(spark, pairs):
    return spark.createDataFrame(pairs, "doc_id BIGINT, quality INT, toxic INT")


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        words = ["".join(rng.choices(["an", "er", "th", "ou", "ing"], k=rng.randrange(1, 4))) for _ in range(rng.randrange(60))]
        rows.append((i, " ".join(w + "***" if i % 4 == 0 else w for w in words)))
    rows += [(300, None), (301, ""), (302, "ab"), (None, "the outing")] + rows[:2]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("selected", F.lit("x")).withColumn("log_weight", F.lit(1))
    return rows, frame.repartition(3)


def test_weights_and_draw(spark, corpus):
    rows, docs = corpus
    labels = labels_of(spark, [(i, int(i % 4 != 0), 0) for i in range(0, 300, 2)] + [(None, 1, 0), (2, 0, 0), (2, 1, 1)])
    good = {i for i in range(4, 300, 2) if i % 4}
    found, weight, drawn, stays = quality.resampled(docs, labels)
    assert found.columns[:4] == docs.columns and {weight, drawn, stays} == {"_log_weight", "drawn_weight", "_selected"}
    got = found.withColumn("noise", quality.gumbel(F.col("doc_id"))).collect()
    want = Counter((d, t, round(w, 6)) for (d, t), w in zip(rows, brute_weights(rows, good)))
    assert Counter((r.doc_id, r.text, round(r[weight], 6)) for r in got) == want
    assert all(r[drawn] == pytest.approx(r[weight] + r.noise) for r in got)
    least = np.percentile([r[weight] for r in got if r.doc_id in good], 0.5)
    k = sum(r[weight] >= least - 1e-9 for r in got)
    chosen = sorted((r[drawn] for r in got if r[stays]), reverse=True)
    assert k <= len(chosen) <= k + 2  # repeated rows tie
    assert np.allclose(chosen[:k], sorted((r[drawn] for r in got), reverse=True)[:k], atol=1e-4)
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(chosen)


def test_without_labels_and_rows(spark, odd_docs, no_docs):
    none = labels_of(spark, [])
    assert quality.good_documents(odd_docs, none).count() == odd_docs.count()
    assert quality.good_documents(no_docs, none).collect() == []
    some = labels_of(spark, [(0, 1, 0), (5, 0, 0)])
    assert quality.good_documents(odd_docs, some).columns == odd_docs.columns


def test_kth_largest(spark):
    rng = random.Random(8)
    values = [rng.getrandbits(52) for _ in range(500)] + [7] * 40 + [(1 << 52) - 1]
    ranks = spark.createDataFrame([(v,) for v in values], "rank BIGINT")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 250, 505, len(values)):
        assert quality.kth_largest(ranks, k) == ordered[k - 1]


def test_gumbel_is_standard(spark):
    noise = [r[0] for r in spark.range(20_000).select(quality.gumbel(F.col("id"))).collect()]
    assert np.mean(noise) == pytest.approx(0.5772, abs=0.03) and np.std(noise) == pytest.approx(1.2825, abs=0.03)


def test_labelled_documents(spark):
    """Fitted on a third of the given labels, judged on the others."""
    try:
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    except Exception:
        pytest.skip("no test tables")
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    found, _, _, stays = quality.resampled(docs, labels.where(fold != 1))
    rates = found.join(labels.where(fold == 1), "doc_id").groupBy("quality").agg(F.avg(F.col(stays).cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in rates.collect()}
    assert kept[1] > 0.9 and kept[0] < 0.3, kept
