"""The trie of rebuilt conversations against a dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from scanlake.llm import prefix_trie
from scanlake.llm.tables import Tables

SCHEMA = "conv_id BIGINT, turn BIGINT, role STRING, text STRING, depth STRING, total INT, n_convs STRING"


def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = defaultdict(list)
    whole = {}
    for c, ts in turns.items():
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(turns.get(base, [])[:h] + ts[h:])
        for d in range(len(whole[c]) + 1):
            members[whole[c][:d]].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * (len(p[-1][1]) if p else 0)
    out = Counter()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in m if whole[c] == p))
        out[min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def got(frame):
    return Counter(tuple(r) for r in frame.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "y") for r in rows], SCHEMA)


def test_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for c in [*range(-130, -90, 7), *range(-3, 40), *range(100, 130), *range(205, 230), 1 << 40]:
        same = rng.random() < 0.4  # many conversations say the same
        for t in range(rng.randrange(1, 9)):
            text = "hi" if same else rng.choice(["hi", "yes", "", None, "Ünï\x00 code " * 3])
            rows.append((c, rng.choice([t, t, None]), rng.choice(["user", "bot", None]) if not same else "user", text))
    rows += rows[:40]  # repeated rows are repeated turns
    rows += [(None, 1, "user", "nobody's"), (None, None, None, None)]
    frame = table(spark, rows)
    want = brute_trie(rows)
    assert got(prefix_trie.trie(frame.repartition(5))) == want
    assert got(prefix_trie.trie(frame.repartition(2))) == want


def test_long_conversation_is_cut_over_tasks(spark):
    rows = [(300, t, "user" if t % 2 else "bot", f"turn {t}") for t in range(700)]
    rows += [(300 + c, t, "user" if t % 2 else "bot", f"turn {t}") for c in range(1, 9) for t in range(6 + c)]
    rows += [(301, 3, "bot", "same")] * 200  # equal rows are dealt out too
    frame = table(spark, rows).repartition(4)
    with Tables(spark, "cut") as tables:
        turns = prefix_trie.hashed_turns(frame, tables)
        assert [r["at"] for r in turns.where("conv_id = 300").orderBy("at").collect()] == list(range(1, 701))
    assert got(prefix_trie.trie(frame)) == brute_trie(rows)


def test_long_end_lists_go_by_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(c, t, "user", f"{t}") for c in [*range(-20, 90), 1000, 1001] for t in range(2)]
    assert got(prefix_trie.trie(table(spark, rows))) == brute_trie(rows)


def test_no_rows_and_no_turns(spark):
    assert prefix_trie.trie(table(spark, [])).collect() == []
    lone = next(c for c in range(1, 90) if zlib.crc32(str(c).encode()) % 6 >= 2)  # all its turns are replaced, by none
    rows = [(lone, 0, "user", "a"), (lone, 1, "bot", "b")]
    assert got(prefix_trie.trie(table(spark, rows))) == brute_trie(rows) == Counter({(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest()): 1})


def test_tables_end_with_the_call(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    prefix_trie.trie(table(spark, [(1, 1, "user", "a")])).collect()
    assert [p.name.endswith("-result") for p in set(shared.iterdir()) - before] == [True]
    with pytest.raises(ZeroDivisionError), Tables(spark, "failing") as tables:
        tables.written(spark.range(3), "numbers")
        1 / 0  # noqa: B018
    assert len(set(shared.iterdir()) - before) == 1
