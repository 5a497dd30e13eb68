"""Patterns by plain regular expressions; gradients by differences; spans of held-out samples."""

import hashlib
import random
import re

import numpy as np
import pytest
from scanlake.llm import lstm_crf, pii


def brute_base(text):
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text or ""):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text or ""):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text or ""):
        digits = [int(c) for c in m[0] if c.isdigit()]
        if 14 <= len(digits) <= 19:
            doubled = [d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits[::-1])]
            if sum(doubled) % 10 == 0:
                found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text or ""):
        if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def texts(n=4000):
    rng = random.Random(3)
    parts = ["a", "b.c", "@", "@@", ".", "-", " ", "+", "1", "25", "255", "256", "0007", "4111 1111 1111 1111", "4111-1111-1111-1111", "378282246310005", "(614)", "é", "🙂", "\n", "%", "_", "com", "+1 (614) 555-8001", "192.168.0.1", "x"]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(n)]


def test_base_spans():
    for text in texts():
        assert pii.base_spans(text) == brute_base(text), text


def test_long_runs_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "a@" * 50_000, "1." * 50_000, "+1" * 50_000, "@" * 100_000, "1 " * 100_000):
        pii.base_spans(text)


def test_gradients():
    rng = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in lstm_crf.new_model(7, 3, 4, 1).items()}
    ids, tags = rng.integers(0, 7, (3, 5)), rng.integers(0, 4, (3, 5))
    _, gradients = lstm_crf.loss_and_gradients(model, ids, tags)
    for name, values in model.items():
        at = tuple(int(rng.integers(0, s)) for s in values.shape)
        kept, step, losses = values[at], 1e-3, []
        for move in (step, -step):
            values[at] = kept + move
            losses.append(lstm_crf.loss_and_gradients(model, ids, tags)[0])
        values[at] = kept
        assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(gradients[name][at], abs=2e-4), name


def test_viterbi_is_best():
    import itertools

    rng = np.random.default_rng(1)
    emitted, moves = rng.normal(size=(3, 5, 3)), rng.normal(size=(3, 3))
    for row, path in zip(emitted, lstm_crf.viterbi(emitted, moves)):
        worth = lambda p: sum(row[t, k] for t, k in enumerate(p)) + sum(moves[a, b] for a, b in zip(p, p[1:]))  # noqa: B023, E731
        assert tuple(path) == max(itertools.product(range(3), repeat=5), key=worth)


@pytest.fixture(scope="module")
def model():
    rng = random.Random(2)
    syllables = ["an", "er", "th", "ou", "ing", "re", "st", "the", "tion"]
    contexts = [" ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(60)) for _ in range(50)]
    ids, tags = pii.training_windows(contexts)
    return lstm_crf.train(ids, tags, pii.SYMBOLS, pii.HIDDEN, pii.TAGS, pii.EPOCHS, pii.SEED)


def test_held_out_spans(model):
    ids, tags = pii.training_windows(["on the thing and rest of an outer ring there is"], 600, seed=77)
    found = lstm_crf.viterbi(lstm_crf.scores(model, ids), pii.allowed_moves(model["moves"]))
    assert (found == tags)[tags > 0].mean() > 0.9 and (found == tags)[tags == 0].mean() > 0.97


def test_added_spans(model):
    lead = "the thing and the rest of it stands here and there, all told " * 3
    samples = ["(614) 555-8001", "4929 1180 0000 1234", "1234567812345678"]
    known = [f"{lead}{s} and so on it goes" for s in samples]
    clean = [lead, "In 1999 there were 12 of them at 10:30, for $30.50, v1.2", ""]
    added = pii.network_spans(model, known + clean, [pii.base_spans(t) for t in known + clean])
    hits = [t[s[0][0] : s[0][2]] if s else None for t, s in zip(known, added)]
    assert sum(h == s for h, s in zip(hits, samples)) >= 2
    assert added[len(known) :] == [[], [], []]


def test_windows_agree_over_long_stretches(model):
    text = "call 4929118000001234, or " * 200
    spans = pii.network_spans(model, [text], [[]])[0]
    assert len(spans) > 150 and all(text[s:e] == "4929118000001234" for s, _, e in spans)


def test_long_stretch_among_short_ones(model):
    import tracemalloc

    long = "call 4929118000001234, or " * 13_000  # one stretch of 325,000 characters
    short = [f"the thing and {i} call (614) 555-80{i % 100:02d} and so on" for i in range(255)]
    tracemalloc.start()
    found = pii.network_spans(model, [long, *short], [[]] * 256)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 300e6
    assert found[1:] == pii.network_spans(model, short, [[]] * 255)
    assert sum(long[s:e] == "4929118000001234" for s, _, e in found[0]) > 9000


def test_blocks_give_the_same_path(model):
    rng = np.random.default_rng(4)
    for n in (5, 64, 65, 32_768, 32_768 + 31, 70_000):
        piece = rng.integers(1, 99, n)
        blocks = list(pii.blended_blocks(model, piece))
        total, weight = np.zeros((n + 64, pii.TAGS)), np.zeros((n + 64, 1))
        at = pii.window_starts(n)
        windows = np.zeros((len(at), 64), np.int64)
        for row, s in enumerate(at):
            windows[row, : len(piece[s : s + 64])] = piece[s : s + 64]
        for s, scored in zip(at, lstm_crf.scores(model, windows)):
            total[s : s + 64] += scored * pii._CENTRAL[:, None]
            weight[s : s + 64] += pii._CENTRAL[:, None]
        assert np.allclose(np.concatenate(blocks), total[:n] / weight[:n], atol=1e-3)
    emitted, moves = rng.normal(size=(1, 500, 5)), rng.normal(size=(5, 5))
    blocks = [emitted[0, i : i + 77] for i in range(0, 500, 77)]
    assert (lstm_crf.viterbi_blocks(iter(blocks), moves) == lstm_crf.viterbi(emitted, moves)[0]).all()


def test_digests(spark, odd_docs, no_docs, model):
    rows = [(i, t) for i, t in enumerate(texts(200))] + [(7, None), (None, "call +1 (614) 555-8001"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    want = []
    for doc_id, text in rows:
        spans = brute_base(text)
        shown = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in spans)
        want.append((doc_id, *[sum(k == i for _, k, _ in spans) for i in range(4)], hashlib.sha256(shown.encode()).hexdigest(), set(shown.split(","))))
    found = [tuple(r) for r in pii.digests(pii.personal_data(docs, model=model)).collect()]
    key = lambda r: str(r[:-1])
    for f, w in zip(sorted(found, key=key), sorted(want, key=key)):
        assert f[:-1] == w[:-1]
    assert pii.personal_data(no_docs).collect() == []
    assert pii.personal_data(odd_docs, model=model).count() == odd_docs.count()
    assert 0 < len(pii.contexts_of(docs, "doc_id", "text", most=5)) <= 5
