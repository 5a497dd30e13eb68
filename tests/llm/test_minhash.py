"""MinHash groups against all pairs of shingle sets."""

import itertools
import random
from collections import Counter

import pytest
from scanlake.llm import minhash
from scanlake.llm.tables import Tables
from test_dedup import ascii_lower, got


def brute_set(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in ascii_lower(text)).split(" ") if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute_groups(rows):
    sets = [brute_set(text) for _, text, *_ in rows]
    parent = list(range(len(rows)))

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    low = {}
    for i, (doc_id, *_) in enumerate(rows):
        if doc_id is not None:
            low[root(i)] = min(doc_id, low.get(root(i), doc_id))
    return Counter((r[0], len(sets[i]), low.get(root(i)), r[0] is not None and r[0] == low.get(root(i))) for i, r in enumerate(rows))


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return words


def crowd(rng, size, length, edits):
    """Near copies of one text, some linked with each other and some with none."""
    words = [f"w{rng.randrange(400)}" for _ in range(length)]
    return [" ".join(edited(rng, words, rng.choice(edits))) for _ in range(size)]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 90))) for _ in range(60)]
    texts += [t.upper() for t in texts[:6]]
    texts += crowd(rng, 60, 90, (0, 1, 1, 2, 2, 3)) + crowd(rng, 20, 500, (1, 4, 9)) + crowd(rng, 12, 900, (2, 8, 14))
    passage = " ".join(f"p{i}" for i in range(60))  # common to many that are not alike
    texts += [" ".join(f"w{rng.randrange(300)}" for _ in range(70)) + " " + passage for _ in range(30)]
    return [(i, t) for i, t in enumerate(texts)] + [(3, texts[70]), (None, texts[80]), (None, "nothing like it"), (-5, texts[150] + " end")]


@pytest.mark.parametrize("k,short", [(minhash.K, minhash.SHORT), (minhash.K, 4), (128, 8)])
def test_brute_force(spark, rows, k, short):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    assert got(minhash.near_groups(docs, k=k, short=short)) == brute_groups(rows)


def test_defined_cases(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = brute_groups(rows)
    for (doc_id, n, _, _), times in list(want.items()):
        if n == 0:  # empty sets are linked with nothing: each row is its own
            assert want[doc_id, 0, doc_id, doc_id is not None] == times
    assert got(minhash.near_groups(odd_docs)) == want
    assert minhash.near_groups(no_docs).collect() == []


def test_crowds_make_few_pairs(spark):
    """Near copies that do not link with each other: neither all pairs nor a cap."""
    rng = random.Random(2)
    words = [f"w{i}" for i in range(58)]
    texts = {" ".join(edited(rng, words, 1)) for _ in range(400)}  # one word of 58 each: similarity 0.69 to 0.84
    rows = [(i, t) for i, t in enumerate(sorted(texts))]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    with Tables(spark, "crowd") as tables:
        classes = minhash.sketched(docs).withColumnRenamed("doc_id", "node")
        classes = tables.written(classes, "classes")
        counts = minhash.bucket_counts(classes)
        long = tables.written(minhash.inverted_lists(classes, counts), "lists").where("length > 8")
        assert long.groupBy("list").count().agg({"count": "max"}).first()[0] > 300
        whole = tables.written(minhash.whole_sets(long.select("node").distinct(), classes, docs, "text", minhash.K), "sets")
        links, lists, _ = minhash.crowd_level(long, whole, counts, tables)
        pairs = minhash.short_pairs(minhash.counted(lists.distinct()).where("length <= 32")).distinct().count()
        assert pairs + links.count() < len(rows) ** 2 / 10
    assert got(minhash.near_groups(docs, short=8)) == brute_groups(rows)


def test_mixed_versions_end_at_once(spark, monkeypatch):
    """Texts that mix versions of their parts share differences with about everyone: lists of differences do not part them."""
    rng = random.Random(6)
    parts = [[" ".join(f"w{rng.randrange(400)}" for _ in range(12)) for _ in range(2)] for _ in range(24)]
    texts = sorted({" ".join(rng.choices(p, (3, 1))[0] for p in parts) for _ in range(160)})
    texts += [t.replace(" ", " y ", 1) for t in texts[:20]]
    rows = list(enumerate(texts))
    entries, level = [], minhash.crowd_level

    def counting(long, *more):
        entries.append(long.count())
        return level(long, *more)

    monkeypatch.setattr(minhash, "crowd_level", counting)
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    assert got(minhash.near_groups(docs, short=8)) == brute_groups(rows)
    assert entries and sum(entries) <= 3 * len(rows), entries


def test_lists_of_the_same_members_are_kept_once(spark):
    entries = [(v, node, 9) for v in range(1, 6) for node in (1, 2, 3)] + [(6, 1, 9), (6, 2, 9), (7, 1, 9)]
    found = minhash.counted(spark.createDataFrame(entries, "list BIGINT, node BIGINT, n BIGINT")).collect()
    assert sorted((r.node, r.length) for r in found) == [(1, 2), (1, 3), (2, 2), (2, 3), (3, 3)]
