"""Base patterns against plain regular expressions; the battery on known strings."""

import hashlib
import random
import re
import string

import numpy as np
import pytest
from scanlake.llm import secrets_scan


def brute_base(text):
    found = []
    for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?[ ]*[:=][ ]*["']?([A-Za-z0-9+/_.=-]+)""", text or ""):
        if len(m.group(2)) >= 8:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if m.end() - m.start() >= 32]
    return sorted(found)


def texts():
    rng = random.Random(3)
    parts = ["password", "PassWd", 'secret"', "toKen'", "api_key", "APIKEY", "apı_key", "toKen", ":", "=", " = ", "\t=", " ", '"', "'", "AKIA", "AKIAAKIA", "abcdef01" * 4, "0" * 31, "ABCdef/+_.=-", "Z" * 12, "é", "🙂", "\n", "x"]
    return ["".join(rng.choices(parts, k=rng.randrange(1, 14))) for _ in range(3000)]


def test_base_spans():
    for text in texts():
        assert secrets_scan.base_spans(text, secrets_scan.code_points(text)) == brute_base(text), text


def random_string(rng, alphabet, n):
    return "".join(rng.choices(alphabet, k=n))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(9)
    syllables = ["an", "er", "th", "ou", "ing", "re", "st", "the", "tion", "and", "ble"]
    rows, planted = [], {}
    for i in range(300):
        words = ["".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(150)]
        words.insert(5, "".join(rng.choices(syllables, k=12)))  # long, but ordinary
        if i % 5 == 0:
            alphabet = [string.ascii_letters + string.digits, string.hexdigits[:16], string.ascii_letters + string.digits + "+/"][i % 3]
            planted[i] = random_string(rng, alphabet, 31 if i % 3 == 1 else 44)
            words.insert(9, planted[i])
        rows.append((i, "é " + " ".join(words)))
    return planted, spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)


def test_random_strings_are_added(corpus):
    planted, docs = corpus
    texts = {r.doc_id: r.text for r in docs.collect()}
    right = wrong = 0
    for r in secrets_scan.secrets(docs).collect():
        assert [tuple(s) for s in r.base] == brute_base(texts[r.doc_id])
        for s in r.added:
            if texts[r.doc_id][s.start : s.end] == planted.get(r.doc_id):
                right += 1
            else:
                wrong += 1
    assert right >= 0.8 * len(planted) and wrong <= 0.1 * (right + wrong)


def test_hot_source_of_digests_hides_no_other(spark):
    rng = random.Random(6)
    syllables = ["an", "er", "th", "ou", "ing", "re", "st", "the", "tion", "and", "ble"]
    prose = lambda n: " ".join("".join(rng.choices(syllables, k=rng.randrange(1, 4))) for _ in range(n))
    base62 = string.ascii_letters + string.digits
    rows, planted = [], {}
    for i in range(200):
        planted[i] = random_string(rng, base62, 44)
        rows.append((i, f"{prose(80)} {planted[i]} {prose(80)}"))
    for i in range(100):  # a third of the rows are digests and blobs
        blobs = [random_string(rng, "0123456789abcdef", 64) if k % 2 else random_string(rng, base62 + "+/", 76) for k in range(30)]
        rows.append((1000 + i, "\n".join(blobs)))
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4)
    texts, right = dict(rows), 0
    for r in secrets_scan.secrets(docs).where("doc_id < 1000").collect():
        right += planted[r.doc_id] in [texts[r.doc_id][s.start : s.end] for s in r.added]
    assert right >= 0.8 * len(planted)


def test_digests(spark, odd_docs, no_docs):
    rows = [(i, t) for i, t in enumerate(texts()[:200])] + [(7, None), (None, "token = abcdefgh1"), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)
    names = ("assign", "access", "hex")
    want = []
    for doc_id, text in rows:
        spans = brute_base(text)
        shown = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in spans)
        want.append((doc_id, *[sum(k == i for _, k, _ in spans) for i in range(3)], hashlib.sha256(shown.encode()).hexdigest(), shown))
    found = [tuple(r) for r in secrets_scan.digests(secrets_scan.secrets(docs)).collect()]
    bare = [(*f[:5], ",".join(s for s in f[5].split(",") if not s.startswith("random"))) for f in found]
    assert sorted(map(str, bare)) == sorted(map(str, want))
    assert secrets_scan.secrets(no_docs).collect() == []
    assert secrets_scan.secrets(odd_docs).count() == odd_docs.count()


def test_random_passes_and_prose_fails():
    rng = random.Random(1)
    for alphabet in (string.ascii_letters + string.digits, "0123456789abcdef", string.ascii_uppercase + "234567"):
        rows = np.array([np.frombuffer(random_string(rng, alphabet, 40).encode(), np.uint8) for _ in range(400)])
        kinds = secrets_scan.infer(rows)
        score = np.array([secrets_scan.battery(r[None], k)[0] for r, k in zip(rows, kinds)])
        assert np.mean(score > secrets_scan.NOT_RANDOM) < 0.02
    words = np.frombuffer(b"thequickbrownfoxandtheothersweretheresto", np.uint8)[None]
    assert secrets_scan.battery(words, int(secrets_scan.infer(words)[0]))[0] > 10
    same = np.frombuffer(b"a" * 40, np.uint8)[None]
    assert secrets_scan.battery(same, int(secrets_scan.infer(same)[0]))[0] > secrets_scan.NOT_RANDOM


def test_false_discovery_rule():
    ordinary, tested = np.zeros((4, secrets_scan.BINS), np.int64), np.zeros((4, secrets_scan.BINS), np.int64)
    ordinary[:, 100:200] = 1000
    tested[1, 2], tested[1, 150], tested[2, 150] = 40, 500, 500
    limits = secrets_scan.discoveries(ordinary, tested, 0.05)
    assert 2 <= limits[1] < 100 and limits[0] < 150 and limits[2] < 150
    assert secrets_scan.discoveries(ordinary, np.zeros_like(tested), 0.05) == [-1] * 4


def test_windows_cover_every_letter(monkeypatch):
    seen = []
    monkeypatch.setattr(secrets_scan, "infer", lambda windows: seen.append(windows) or np.full(len(windows), -1))
    windows = secrets_scan.Windows()
    codes = np.arange(250, dtype=np.uint8)  # letters are told apart by their code
    monkeypatch.setattr(secrets_scan, "_IS_WORD", np.ones(256, bool))
    windows.add(codes)
    windows.flush()
    assert [w.shape[1] for w in seen] == list(secrets_scan.CLASSES)
    for w in seen:
        assert set(w.ravel().tolist()) == set(range(250))
