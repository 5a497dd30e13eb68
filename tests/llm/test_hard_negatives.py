"""Hard negatives and the tree's search against all scores."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from scanlake.llm import hard_negatives as hn
from test_dedup import got

SCHEMA = "id BIGINT, label INT, vector ARRAY<FLOAT>, rank STRING, q INT, leaf STRING"


def brute_negatives(rows, step):
    known = set()
    for i, label, vector, *_ in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known.add((i, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2]))
    out = Counter()
    for a in known:
        if a[0] % step:
            continue
        order = lambda found: sorted(found, key=lambda r: (-score(a, r), r[0]))
        unlike = [r for r in known if r[1] != a[1]]
        for p in order([r for r in known if r[1] == a[1] and r != a])[:5]:
            s = score(a, p)
            fits = order([r for r in unlike if 80 * s <= 100 * score(a, r) <= 100 * s])[:5]
            for rank, n in enumerate(fits, 1):
                out[a[0], p[0], rank, n[0], s, score(a, n)] += 1
    return out


def vectors(rng, count, size, groups):
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(groups)]
    for i in range(count):
        c = rng.choice(centres)
        yield i, rng.randrange(4), [x + rng.gauss(0, rng.choice([0.0, 0.2, 0.6])) for x in c]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("fan,leaves,block", [(4, 60, 16), (16, 512, 1024), (2, 2, 8)])
def test_brute_force(spark, fan, leaves, block):
    rng = random.Random(fan)
    rows = list(vectors(rng, 320, 6, 12))
    rows += [(400 + i, i % 4, rows[7][2]) for i in range(90)]  # one common vector, ties of all kinds
    rows += rows[:20]  # repeated rows are one
    rows += [(30, 3, [0.1] * 6), (60, 1, [0.0] * 6), (61, 1, [-5.0] * 6), (62, 2, []), (63, 0, [1.0])]
    rows += [(90, None, [1.0] * 6), (120, 1, None), (150, 1, [float("nan")] * 6), (180, 1, [1.0, None, 1.0]), (None, 1, [1.0] * 6), (210, 2, [float("inf")])]
    found = hn.hard_negatives(table(spark, rows), F.col("id") % 10 == 0, fan=fan, leaves=leaves, block=block)
    assert got(found) == brute_negatives(rows, 10)


def test_few_rows(spark):
    for rows in ([], [(0, 1, [1.0])], [(0, 1, [1.0]), (1, 1, [1.0])], [(0, 1, [1.0]), (1, 1, [1.0]), (2, 0, [0.9])]):
        assert got(hn.hard_negatives(table(spark, rows), F.col("id") % 10 == 0)) == brute_negatives(rows, 10)


def test_only_leaves_without_a_match_are_left_out():
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 200, (30, 8))
    rows = np.floor(centres[rng.integers(0, 30, 3000)] + rng.normal(0, 25, (3000, 8)))
    square = float((rows**2).sum(axis=1).max())
    nodes = hn.fit(hn.lifted(rows[::4], square), 8, 64)
    leaf, found = hn.descend(nodes, hn.lifted(rows, square))
    ranges = {(at, child): (low, high) for at, child, low, high in found}
    queries = rows[::100]
    scores = queries @ rows.T
    best, worst = np.sort(scores, axis=1)[:, -3], np.sort(scores, axis=1)[:, -40]
    length = lambda s: np.sqrt(np.maximum((queries**2).sum(axis=1) + square - 2 * s, 0))
    left = hn.surviving(nodes, ranges, queries, square, length(best), length(worst))
    visited = 0
    for query, leaves, high, low in zip(scores, left, best, worst):
        inside = set(leaf[(query >= low) & (query <= high)])
        assert inside <= set(leaves.tolist())
        visited += len(leaves)
    assert visited < 0.5 * len(queries) * len(set(leaf.tolist()))  # clustered vectors: most siblings are eliminated


def test_asked_anchors_are_not_broadcast(spark, monkeypatch):
    """The planner takes an anchor for one row, however many leaves it looks in."""
    rng = random.Random(3)
    plans = []
    search = hn.search

    def seen(*args):
        plans.append(search(*args)._jdf.queryExecution().executedPlan().toString())
        return search(*args)

    monkeypatch.setattr(hn, "search", seen)
    rows = list(vectors(rng, 200, 4, 5))
    found = hn.hard_negatives(table(spark, rows), F.col("id") % 10 == 0, fan=4, leaves=20, block=16)
    assert got(found) == brute_negatives(rows, 10)
    assert len(plans) == 4 and not any("Broadcast" in plan for plan in plans)


def test_groups_hold_equal_numbers_of_blocks():
    counts = [0, 1, 5000, 3, 1]
    groups, first, spans = hn.groups_of(counts)
    sizes = Counter((f + b) * groups // sum(max(n, 1) for n in counts) for f, n in zip(first, counts) for b in range(max(n, 1)))
    assert len(sizes) == groups == 64 and max(sizes.values()) <= hn.GROUP_BLOCKS
    assert spans[0] == (0, 0) and spans[2][1] == 63 and all(a <= b for a, b in spans)
    assert hn.groups_of([])[0] == 1 and hn.groups_of([1] * 3)[0] == 3
    assert hn.groups_of([hn.GROUP_BLOCKS * 100])[0] == 100
    assert hn.reach_of([2, 4], [(0, 0), (0, 0), (0, 1), (1, 1), (1, 1)]) == [{"group": 0, "leaves": [2]}, {"group": 1, "leaves": [2, 4]}]
