"""Gradients by differences, pooling against a plain loop, accuracy on the held-out fold."""

import random
import zlib

import numpy as np
import pytest
from scanlake.llm import gru, language


def test_gradients():
    rng = np.random.default_rng(0)
    model = {k: v.astype(np.float64) for k, v in gru.new_model(3, 4, 1).items()}
    data = rng.integers(60, 64, (3, 5)).astype(np.uint8)
    used, labels = np.ones((3, 5), bool), np.array([0, 2, 3])
    used[1, 3:] = False
    _, gradients = gru.loss_and_gradients(model, data, used, labels)
    for name, values in model.items():
        at = (int(data[0, 2]), 4) if name.startswith("in") else tuple(int(rng.integers(0, s)) for s in values.shape)
        kept, step, losses = values[at], 1e-4, []
        for move in (step, -step):
            values[at] = kept + move
            losses.append(gru.loss_and_gradients(model, data, used, labels)[0])
        values[at] = kept
        assert (losses[0] - losses[1]) / (2 * step) == pytest.approx(gradients[name][at], abs=1e-6), name


def plain_probabilities(model, text):
    """One byte at a time."""
    total = np.zeros(len(model["out_0"]))
    for start in range(0, len(text), language.WINDOW):
        part = text[start : start + language.WINDOW]
        states = {}
        for side in "fb":
            padded = list(part) + [0] * (language.WINDOW - len(part))
            h, out = np.zeros(language.HIDDEN), []
            for b in padded if side == "f" else padded[::-1]:
                a, u = model[f"in_{side}"][b].astype(float), h @ model[f"rec_{side}"]
                k = language.HIDDEN
                z, r = np.clip(a[:k] + u[:k], 0, 1), np.clip(a[k : 2 * k] + u[k : 2 * k], 0, 1)
                n = np.clip(a[2 * k :] + r * u[2 * k :], -1, 1)
                h = n + z * (h - n)
                out.append(h)
            states[side] = out if side == "f" else out[::-1]
        for f, b in list(zip(states["f"], states["b"]))[: len(part)]:
            s = f @ model["out_f"] + b @ model["out_b"] + model["out_0"]
            total += np.exp(s - s.max()) / np.exp(s - s.max()).sum()
    return total / max(1, len(text))


def test_pooling_covers_whole_texts():
    rng = random.Random(1)
    model = gru.new_model(language.HIDDEN, 3, 7)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (1, 63, 64, 65, 300, 0)]
    found = language.document_probabilities(model, texts)
    for text, row in zip(texts, found):
        assert np.allclose(row, plain_probabilities(model, text), atol=1e-4)


def corpus(n):
    rng = random.Random(2)
    parts = {"aa": ["an", "er", "th", "ou", "ing", "tion"], "bb": ["sch", "ein", "ung", "ü", "keit"], "cc": ["ció", "ñ", "os", "que", "ar"]}
    rows = []
    for i in range(n):
        lang = rng.choice(list(parts))
        words = ["".join(rng.choices(parts[lang], k=rng.randrange(1, 4))) for _ in range(rng.randrange(3, 60))]
        rows.append((i, " ".join(words), lang if i % 10 else None, f"src{i % 3}", lang))
    return rows


def test_predictions(spark, no_docs):
    rows = corpus(600) + [(700, None, "aa", None, None), (701, "", "aa", None, None), (702, "12 34 !?", "bb", None, None), (None, "the outing", None, None, None), (703, "x " * 30_000, None, None, None)]
    rows += rows[:1]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING, source STRING, score STRING").repartition(3)
    found = language.languages(docs).collect()
    assert len(found) == len(rows)
    truth = {r[0]: r[4] for r in rows}
    right = total = 0
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.lang_pred in {"aa", "bb", "cc", "und"}
        if r.doc_id in (700, 701, 702):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.held_out and r.doc_id < 600:
            total += 1
            right += r.lang_pred == truth[r.doc_id]
    assert total > 100 and right >= 0.97 * total
    assert language.languages(no_docs).collect() == []


def test_only_the_training_fold_is_read(spark, odd_docs):
    rows = [(i, "text of it " + str(i), "right" if zlib.crc32(str(i).encode()) % 3 != 1 else "wrong") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, lang STRING")
    pieces = language.training_pieces(docs, "doc_id", "text", "lang")
    assert {name for name, _ in pieces} == {"right"}
    no_langs = odd_docs.drop("lang").selectExpr("*", "CAST(NULL AS STRING) AS lang")
    assert {r.lang_pred for r in language.languages(no_langs).collect()} == {"und"}


def test_given_documents(spark):
    try:
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    except Exception:
        pytest.skip("no test tables")
    found = language.languages(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    assert found.where("lang_pred = lang").count() > 0.97 * found.count()
