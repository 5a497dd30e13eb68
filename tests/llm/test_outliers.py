"""Statistics by plain code, and the estimates recomputed group by group in numpy."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from scanlake.llm import outliers


def brute_statistics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated), len(lines))


def make(n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "de", None]), rng.choice(["hot"] * 5 + ["cold", None, "rare" if rng.random() < 0.1 else "hot"])
        words = ["".join(rng.choices(["an", "er", "th", "ou", "ing"], k=rng.randrange(1, 5))) for _ in range(int(math.exp(rng.gauss(5, 0.5))))]
        if i % 12 == 0:
            words = [w + "***" for w in words]
        if i % 17 == 0:
            words[9:9] = words[:8]
        if i % 29 == 0:
            words = words[:3] * 40
        text = " ".join(words)
        if i % 13 == 0:
            text = text[:60] + "\n" + text[:60] + "\n \n\n" + text
        rows.append((i, text, lang, source, None))
    return rows


SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, kept STRING"


@pytest.fixture(scope="module")
def corpus(spark):
    rows = make(1500, 5) + [(2000, None, "en", "hot", None), (2001, "", None, None, None), (2002, "é# 漢|\v\f<x>", "xx", "yy", "z"), (None, "a b c " * 50, None, None, None)]
    rows += rows[:2]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_statistics():
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choices(["a", "b", " ", "  ", "\n", "\n", "a b c", "\t", "#", "|", "é", " ", "\x1c", "x y z\n"], k=rng.randrange(20)))
        assert outliers.statistics(text) == brute_statistics(text), repr(text)
    assert outliers.statistics(None) == (0, 0, 0, 0, 0, 0)


def brute_determinant(x, center, cov):
    """Concentration steps over single rows; log determinant, center and covariance of the nearest half."""
    half, last = (len(x) + 6) // 2, np.inf
    while True:
        near = np.argsort(np.einsum("ni,ij,nj->n", x - center, np.linalg.inv(cov), x - center), kind="stable")[:half]
        center, cov = x[near].mean(axis=0), outliers.floored(np.cov(x[near].T, bias=True))
        size = np.linalg.slogdet(cov)[1]
        if size >= last - 1e-9:
            return last, center, cov
        last = size


def test_least_determinant_of_many_starts():
    """Cells of one row each: from the same 300 starts the most compact half is that found over rows."""
    rng = np.random.default_rng(3)
    for spread in (0.5, 1.5):
        x = np.vstack([rng.normal(0, [1, 0.3, 2, 0.2, 1], (90, 5)), rng.normal([4, 3, 9, 0, 2], spread, (45, 5))])
        cells = outliers.Cells(np.ones(len(x)), x, np.einsum("ni,nj->nij", x, x))
        subsets = [rng.choice(len(x), 6, replace=False) for _ in range(300)]
        brute = min(brute_determinant(x, x[s].mean(axis=0), outliers.floored(np.cov(x[s].T, bias=True)))[0] for s in subsets)
        starts = [cells.moments(np.bincount(s, minlength=len(x)).astype(float)) for s in subsets]
        found = min(outliers.concentrate(cells, c, outliers.floored(v))[0] for c, v in starts)
        assert found == pytest.approx(brute, abs=1e-6)
        center, cov = outliers.estimate(cells)
        distance = np.einsum("ni,ij,nj->n", x - center, np.linalg.inv(cov), x - center)
        assert (distance[90:] > outliers.CUT).all() and (distance[:90] <= outliers.CUT).mean() > 0.93


def test_folded_cells_add_up():
    rng = np.random.default_rng(4)
    x = rng.normal(0, 1, (400, 5))
    parts = np.array_split(x, 37)
    whole = outliers.Cells(np.array([float(len(p)) for p in parts]), np.array([p.sum(axis=0) for p in parts]), np.array([p.T @ p for p in parts]))
    center, cov = whole.moments(np.ones(37))
    assert np.allclose(center, x.mean(axis=0)) and np.allclose(cov, np.cov(x.T, bias=True))
    inverse = np.linalg.inv(cov)
    each = [np.mean(np.einsum("ni,ij,nj->n", p - center, inverse, p - center)) for p in parts]
    assert np.allclose(whole.distances(center, cov), each)
    taken = whole.nearest(whole.distances(center, cov), 151.5)
    assert taken @ whole.n == pytest.approx(151.5) and ((taken > 0) & (taken < 1)).sum() <= 1


def test_judged(corpus):
    rows, docs = corpus
    found = outliers.judged(docs).collect()
    want = Counter((r[0], *brute_statistics(r[1])[:5]) for r in rows)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found) == want
    assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in found)
    assert all(not r.kept and r.distance is None for r in found if r.base_failed)

    # The same statistics, grid and groups by plain code; the estimate of each group from its cells.
    values, groups = {}, defaultdict(list)
    for row in rows:
        n, chars, symbols, dup, rep, lines = brute_statistics(row[1])
        if n >= 50 and 100 * rep <= 50 * n:
            v = [math.log1p(n), math.log1p(chars / n), math.log1p(100 * symbols / n), math.log1p(100 * dup / lines), math.log1p(100 * rep / n)]
            x = np.array([int(math.floor(a * 1024 + 0.5)) for a in v])
            values[row[0]] = (x, row[2], row[3])
            for key in ((row[2], row[3]), (row[2],), ()):
                groups[key].append(x)
    fitted = {}
    for r in found:
        if not r.base_failed:
            x, lang, source = values[r.doc_id]
            key = next(k for k in ((lang, source), (lang,), ()) if len(groups[k]) >= outliers.LEAST)
            if key not in fitted:
                cells = defaultdict(list)
                for y in groups[key]:
                    cells[tuple(y // np.array(outliers.WIDTHS))].append(y / 1024)
                parts = [np.array(cells[c]) for c in sorted(cells)]
                fitted[key] = outliers.estimate(outliers.Cells(np.array([float(len(p)) for p in parts]), np.array([p.sum(axis=0) for p in parts]), np.array([p.T @ p for p in parts])))
            center, cov = fitted[key]
            off = x / 1024 - center
            assert r.distance == pytest.approx(off @ np.linalg.inv(cov) @ off, rel=1e-5, abs=1e-5)
            assert r.kept == (r.distance <= outliers.CUT)
    assert {len(k) for k in fitted} == {1, 2}
    starred = [r for r in found if r.doc_id is not None and r.doc_id < 1500 and r.doc_id % 12 == 0 and not r.base_failed]
    plain = [r for r in found if r.doc_id is not None and r.doc_id < 1500 and r.doc_id % 12 and not r.base_failed]
    assert not any(r.kept for r in starred) and sum(r.kept for r in plain if r.n_dup_lines + r.n_repeat_words == 0) > 0.95 * sum(r.n_dup_lines + r.n_repeat_words == 0 for r in plain)


def test_a_third_of_copies_or_junk(spark):
    rng = random.Random(8)
    text = lambda n, mark="": " ".join("".join(rng.choices(["an", "er", "th", "ou", "ing"], k=rng.randrange(1, 5))) + mark for _ in range(n))
    plain = [text(int(math.exp(rng.gauss(5, 0.5))) + 50) for _ in range(200)]
    copies = [text(120, "***")] * 100
    junk = [text(rng.randrange(60, 400), "#" * rng.randrange(1, 9)) for _ in range(100)]
    for n, bad in enumerate((copies, junk)):
        docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(plain + bad)], SCHEMA).repartition(3)
        kept = {r.doc_id for r in outliers.judged(docs).where("kept").collect()}
        assert not any(i in kept for i in range(200, 300)), n
        assert sum(i in kept for i in range(200)) > 0.95 * 200


def test_repetition_below_the_base_limit(spark):
    """A third of the lines, or a third of the words, repeated among clean documents of one group."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choices(["an", "er", "th", "ou", "ing", "est"], k=rng.randrange(1, 5))) + rng.choice("abcdefgh") * rng.randrange(3)
    lines = lambda n: [" ".join(word() for _ in range(rng.randrange(6, 14))) for _ in range(int(n))]
    clean = ["\n".join(lines(8 + math.exp(rng.gauss(3, 0.4)))) for _ in range(600)]
    repeated_lines = ["\n".join((lambda x: x + x[:11])(["\t".join([str(i), *p.split()[:2], str(i)]) if i < 11 else p for i, p in enumerate(lines(24))])) for _ in range(40)]
    phrases = []
    for _ in range(40):
        own, often = lines(20), " ".join(word() for _ in range(8))
        phrases.append("\n".join(p + " " + often if i % 2 else p for i, p in enumerate(own)))
    texts = clean + repeated_lines + phrases
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    found = {r.doc_id: r for r in outliers.judged(docs).collect()}
    planted = [found[i] for i in range(600, 680)]
    assert all(not r.base_failed for r in planted)
    assert sum(not r.kept for r in planted[:40]) >= 36 and sum(not r.kept for r in planted[40:]) >= 36
    assert sum(found[i].kept for i in range(600)) > 0.95 * 600


def test_reruns_agree(corpus):
    _, docs = corpus
    assert sorted(map(str, outliers.judged(docs).collect())) == sorted(map(str, outliers.judged(docs.repartition(7)).collect()))


def test_odd_tables(spark, odd_docs, no_docs):
    found = outliers.judged(odd_docs)
    assert found.count() == odd_docs.count()
    assert outliers.judged(no_docs).collect() == []
    same = spark.createDataFrame([(i, "a b c d e " * 1 + "x" * i + " w " + " ".join(f"q{j}" for j in range(60)), "en", "s", None) for i in range(3)], SCHEMA)
    assert all(r.kept and r.distance is None for r in outliers.judged(same).collect())
