"""Exact and near duplicates against brute force."""

import hashlib
import itertools
import random
from collections import Counter

import xxhash
from scanlake.llm import exact_dedup, simhash


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_exact(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(ascii_lower(text), []).append(doc_id)
    out = Counter()
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        left = True
        for doc_id in ids:
            out[doc_id, keep, len(ids), left and doc_id == keep, hashlib.sha256(text.encode()).hexdigest()] += 1
            left = left and doc_id != keep
    return out


def got(frame):
    return Counter(map(tuple, frame.collect()))


def test_exact_groups(odd_docs, no_docs):
    rows = odd_docs.collect()
    assert got(exact_dedup.exact_groups(odd_docs)) == brute_exact(rows)
    assert exact_dedup.exact_groups(no_docs).collect() == []


def test_collisions_are_chained(odd_docs):
    rows = odd_docs.collect()
    assert got(exact_dedup.exact_groups(odd_docs, key_of=lambda data: len(data) % 2 - 1)) == brute_exact(rows)
    kept = exact_dedup.drop_exact(odd_docs, key_of=lambda data: 5).collect()
    assert len(kept) == len({ascii_lower(r.text) for r in rows})


def test_small_pages_give_the_same(odd_docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "PAGE_BYTES", 600)
    assert got(exact_dedup.exact_groups(odd_docs)) == brute_exact(odd_docs.collect())


def test_drop_exact_keeps_whole_rows(odd_docs, no_docs):
    kept = exact_dedup.drop_exact(odd_docs)
    assert kept.columns == odd_docs.columns and kept.dtypes == odd_docs.dtypes
    rows = Counter(map(tuple, odd_docs.collect()))
    found = kept.collect()
    assert all(rows[tuple(r)] for r in found)
    stays = Counter(k[0] for k, n in brute_exact(odd_docs.collect()).items() if k[3] for _ in range(n))
    assert Counter(r.doc_id for r in found) == stays
    assert exact_dedup.drop_exact(no_docs).collect() == []


def test_directory_doubles_until_buckets_fit():
    rng = random.Random(3)
    sizes = {p: rng.choice([0, 1, 50]) for p in range(256)}
    slots = exact_dedup.directory(sizes, 8, 120)
    width = 256 // len(slots)
    assert len(slots) & (len(slots) - 1) == 0 and slots == sorted(slots)
    by_bucket = Counter()
    for p, size in sizes.items():
        by_bucket[slots[p // width]] += size
    assert max(by_bucket.values()) <= 120
    assert exact_dedup.directory({}, 8, 1) == [0]
    assert len(exact_dedup.directory({7: 10**9}, 8, 1)) == 256


def brute_print(text):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in ascii_lower(text)).split(" ") if w]
    if not words:
        return 0
    shingles = [words] if len(words) < 3 else [words[i : i + 3] for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(" ".join(s).encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    """doc_id, print pairs to (doc_id, print, component)."""
    nodes = sorted({p for _, p in prints})
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if (a ^ b).bit_count() <= 2:
            parent[root(a)] = root(b)
    low = {}
    for doc_id, p in prints:
        if doc_id is not None:
            low[root(p)] = min(doc_id, low.get(root(p), doc_id))
    return Counter((doc_id, f"{p:016x}", low.get(root(p))) for doc_id, p in prints)


def test_near_groups(odd_docs, no_docs):
    prints = [(r.doc_id, brute_print(r.text)) for r in odd_docs.collect()]
    found = simhash.near_groups(odd_docs).select("doc_id", "fingerprint", "component_id")
    assert got(found) == brute_components(prints)
    assert simhash.near_groups(no_docs).collect() == []
    kept = simhash.drop_near(odd_docs)
    assert kept.columns == odd_docs.columns
    # One row of each component stays: that of its smallest id, or one without any.
    found = [(r.doc_id, brute_print(r.text)) for r in kept.collect()]
    component = {(doc_id, fp): low for doc_id, fp, low in brute_components(prints)}
    assert Counter(component[doc_id, f"{fp:016x}"] for doc_id, fp in found) == Counter({low: 1 for low in component.values()})
    assert all(doc_id == component[doc_id, f"{fp:016x}"] for doc_id, fp in found)


def test_drop_near_decides_by_row(spark):
    words = "the quick brown fox jumps over the lazy dog near the river bank and then it sleeps".split()
    near, unique, other = " ".join(words), "an entirely different line of words", "something else again that nobody has written before"
    bare, twice = "these words have no id at all in any copy", "this text comes back in the very same row"
    rows = [
        (1, near, "a"), (5, near.upper(), "b"), (None, near, "c"),  # null id in a component with ids
        (None, unique, "d"),  # a unique text without an id
        (5, other, "e"),  # the id of a dropped row, with a text of its own
        (None, bare, "f"), (None, bare.upper(), "g"), (None, bare, "f"),  # copies without any id
        (9, twice, "h"), (9, twice, "h"), (9, twice, "i"),
    ]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, row STRING").repartition(3)
    found = [tuple(r) for r in simhash.drop_near(docs).collect()]
    assert found.count((1, near, "a")) == found.count((None, unique, "d")) == found.count((5, other, "e")) == 1
    assert sum(r[1].lower() == bare for r in found) == sum(r[:2] == (9, twice) for r in found) == 1
    assert len(found) == 5 and set(found) <= set(rows)
    assert Counter(found) == Counter(tuple(r) for r in simhash.drop_near(docs.repartition(5)).collect())


def test_links_and_chains(spark):
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(40):  # chains of steps of one to three bits, and dense clouds
        p = rng.getrandbits(64)
        for _ in range(rng.randrange(12)):
            prints.add(p)
            for b in rng.sample(range(64), rng.randrange(1, 4)):
                p ^= 1 << b
    centre = rng.getrandbits(64)
    prints |= {centre ^ (1 << a) for a in range(40)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = {frozenset(x) for x in itertools.combinations(signed, 2) if ((x[0] ^ x[1]) & (1 << 64) - 1).bit_count() <= 2}
    frame = spark.createDataFrame([(s,) for s in signed], "fp BIGINT")
    for segments in (4, 8):
        pairs = [tuple(r) for r in simhash.links(frame, segments).collect()]
        assert {frozenset(p) for p in pairs} == want and len(pairs) == len(want)
    labels = {r.node: r.label for r in simhash.components(simhash.links(frame)).collect()}
    parts = brute_components([(s, s & (1 << 64) - 1) for s in signed])
    for doc_id, _, low in parts:
        assert labels.get(doc_id, doc_id) == low


def test_long_path_settles(spark):
    edges = spark.range(300).selectExpr("id AS a", "id + 1 AS b")
    assert {r.label for r in simhash.components(edges).collect()} == {0}
