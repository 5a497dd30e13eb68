"""Encoding against the public tokenizer library, decoding as a round trip."""

import base64
import hashlib
import random

import numpy as np
import pytest
from scanlake.llm import byte_bpe

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
FILES = ["byte_bpe_multi_50k.tiktoken", "byte_bpe_50k.tiktoken"]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    with open(public_tokenizers.path(request.param), "rb") as file:
        data = file.read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines())}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return byte_bpe.read_vocabulary(data, public_tokenizers.PATTERN), plain


def ids_of(vocabulary, text):
    return np.frombuffer(vocabulary.encode(text), "<i4").tolist()


def test_random_texts(pair):
    vocabulary, plain = pair
    rng = random.Random(1)
    tokens = list(vocabulary.tokens.values())
    alphabets = ["ab", "aA' \n", "etaoin shrdlu", "0123456789.,", "éèçñß äöü", "漢字かな한글", "🙂👩‍👩‍👧‍️", "".join(map(chr, range(0x250)))]
    for n in range(4000):
        if n % 2:
            text = "".join(rng.choices(alphabets[n // 2 % len(alphabets)], k=rng.randrange(40)))
        else:
            text = b"".join(rng.choices(tokens, k=rng.randrange(8))).decode("utf-8", "ignore")
        ids = ids_of(vocabulary, text)
        assert ids == plain.encode_ordinary(text), text
        assert vocabulary.decode(np.array(ids, int)).tobytes() == text.encode()


def test_long_pieces(pair):
    vocabulary, plain = pair
    rng = random.Random(2)
    for text in ("a" * 30_000, "ab" * 9_999, "".join(rng.choices("abcdefgh", k=20_000)), " " * 5000 + "x" + "\n" * 5000, "é" * 9000):
        assert ids_of(vocabulary, text) == plain.encode_ordinary(text)


def test_memos_are_bounded(pair, monkeypatch):
    vocabulary, plain = pair
    monkeypatch.setattr(byte_bpe, "PIECES", 5)
    monkeypatch.setattr(byte_bpe, "PAIRS", 5)
    text = "The memo of pieces holds only a few entries, entries, entries of them all the same"
    assert ids_of(vocabulary, text) == plain.encode_ordinary(text)
    vocabulary.encode(text[::-1])
    assert len(vocabulary.young) <= 5 and len(vocabulary.pairs) <= 5


def test_spaces_of_all_kinds(pair):
    vocabulary, plain = pair
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choices([" ", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "\x85", "a", "the", "1", "'s", ",", "é"], k=rng.randrange(14)))
        assert ids_of(vocabulary, text) == plain.encode_ordinary(text), repr(text)


def test_columns_go_both_ways(spark, odd_docs):
    from pyspark.sql import functions as F

    codec = byte_bpe.Codec(spark, public_tokenizers.path(FILES[1]), public_tokenizers.PATTERN)
    rows = odd_docs.select("text", codec.encode(F.col("text")).alias("ids")).select("text", codec.decode(F.col("ids")).alias("back"))
    assert all(bytes(r.back) == (r.text or "").encode() for r in rows.collect())


def test_query_columns(odd_docs, no_docs):
    path = public_tokenizers.path(FILES[0])
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = byte_bpe.digests(byte_bpe.encoded(odd_docs, path, public_tokenizers.PATTERN)).drop("ids", "decoded").collect()
    want = []
    for r in odd_docs.collect():
        ids = plain.encode_ordinary(r.text or "")
        decoded = hashlib.sha256((r.text or "").encode()).hexdigest()
        want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), decoded))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert byte_bpe.encoded(no_docs, path, public_tokenizers.PATTERN).collect() == []


def test_latin_pattern_is_the_same():
    import regex

    wide, latin = regex.compile(public_tokenizers.PATTERN), byte_bpe.latin_pattern(public_tokenizers.PATTERN)
    rng = random.Random(4)
    every = list(map(chr, range(256))) + ["'s", "'ll", "  ", " a", "ab", "12"] * 8
    for _ in range(5000):
        text = "".join(rng.choices(every, k=rng.randrange(12)))
        assert wide.findall(text) == latin.findall(text), repr(text)
    assert byte_bpe.latin_pattern(r"\w+") is None


def test_vocabulary_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        byte_bpe.Vocabulary({b"a": 0}, ".")
