"""Mixing: targets against a plain water level, sums against all subsets."""

import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from scanlake.llm import mixing


def brute_targets(sizes):
    """sizes by source to targets, sharing the excess again and again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    settled, total = {}, sum(sizes.values())
    while True:
        left = total - sum(settled.values())
        free = [s for s in names if s not in settled]
        share = {s: weight[s] * left / sum(weight[x] for x in free) for s in free}
        over = {s: 3 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not over:
            return settled | share
        settled |= over


def test_fit_is_nearest():
    rng = random.Random(1)
    for _ in range(300):
        lengths = rng.sample(range(0, 30), rng.randrange(1, 6))
        counts = [rng.randrange(1, 4) for _ in lengths]
        total = sum(n * c for n, c in zip(lengths, counts))
        budget = rng.randrange(total + 3)
        chosen = mixing.fit(lengths, counts, budget)
        got = sum(n * c for n, c in zip(lengths, chosen))
        assert all(0 <= c <= n for c, n in zip(chosen, counts))
        sums = {sum(n * c for n, c in zip(lengths, pick)) for pick in itertools.product(*[range(c + 1) for c in counts])}
        assert abs(got - budget) == min(abs(s - budget) for s in sums)


def test_fit_of_large_sources_is_exact():
    rng = random.Random(2)
    lengths = list(range(1, 400))
    counts = [rng.randrange(1, 5000) for _ in lengths]
    total = sum(n * c for n, c in zip(lengths, counts))
    for budget in (1, total // 3, total // 2 + 1, total - 1):
        chosen = mixing.fit(lengths, counts, budget)
        assert sum(n * c for n, c in zip(lengths, chosen)) == budget
        assert all(0 <= c <= n for c, n in zip(chosen, counts))


def make(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING, source STRING, size STRING, copy INT")


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        source = rng.choice(["big"] * 6 + ["b", "Z", "é", "\U0001f600", "", None])
        words = 5 if i % 3 == 0 else rng.choice([0, 1, 2, 3, 7, 40])
        rows.append((i, None if i == 9 else " \n".join(["wörd"] * words), source, "x", 1))
    return make(spark, rows + [rows[0]] * 2 + [(None, "a b", "b", None, None)])


def test_mixed(docs):
    found = mixing.mixed(docs).collect()
    sizes = defaultdict(int)
    for r in docs.collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    aims = brute_targets(sizes)
    taken = defaultdict(int)
    for r in found:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(aims[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        taken[r.source] += r.taken
    for source, aim in aims.items():
        assert abs(taken[source] - aim) <= 5, source
    assert Counter((r.doc_id, r.size, r.source) for r in found) == Counter(
        (r.doc_id, len((r.text or "").split()), r.source) for r in docs.collect()
    )
    assert sorted(map(str, found)) == sorted(map(str, mixing.mixed(docs.repartition(5)).collect()))


def test_mix_repeats_rows(docs, odd_docs, no_docs):
    copies = Counter()
    for r in mixing.mixed(docs).collect():
        copies[r.doc_id] += r.copies if r.size else 0
    out = mixing.mix(docs)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == +copies
    assert mixing.mixed(odd_docs).count() == odd_docs.count()
    assert mixing.mix(odd_docs).columns == odd_docs.columns and mixing.mix(odd_docs).count() > 0
    assert mixing.mixed(no_docs).collect() == [] and mixing.mix(no_docs).collect() == []


def test_only_empty_texts(spark):
    rows = mixing.mixed(make(spark, [(1, None, "a", None, None), (2, "", None, None, None)])).collect()
    assert {(r.target, r.taken) for r in rows} == {(0.0, 0)}


def test_hot_length_and_ties(spark):
    rows = [(i // 3, "a b c", "hot", None, None) for i in range(900)] + [(10_000 + i, "x " * 300, "other", None, None) for i in range(10)]
    found = mixing.mixed(make(spark, rows)).collect()
    taken = sum(r.taken for r in found if r.source_size == 2700)
    aim = next(r.target for r in found if r.source_size == 2700)
    assert abs(aim - taken) <= 3


@pytest.mark.parametrize("text", ["one text for all of them and ten words long", None])
def test_rows_without_an_id_count_singly(spark, text):
    """900 of 1000 rows have no id; of equal rows as many are taken as fit."""
    words = lambda i: text or " ".join(f"w{i}x{j}" for j in range(10))
    rows = [(None if i % 10 else i, words(i), "a" if i % 3 else "b", None, None) for i in range(1000)]
    docs = make(spark, rows).repartition(4)
    found = mixing.mixed(docs).collect()
    assert Counter((r.doc_id, r.source, r.size) for r in found) == Counter((r[0], r[2], len(r[1].split())) for r in rows)
    size = len(rows[0][1].split())
    for source in "ab":
        mine = [r for r in found if r.source == source]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= size and all(r.copies <= 3 for r in mine)
    again = mixing.mixed(docs.repartition(7)).collect()
    assert Counter(map(str, found)) == Counter(map(str, again))
    out = mixing.mix(docs)
    assert Counter((r.doc_id, r.source, r.text) for r in out.collect()).total() == sum(r.copies for r in found)
    assert Counter(r.source for r in out.collect()) == Counter(r.source for r in found for _ in range(r.copies))
