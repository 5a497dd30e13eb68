"""The pipeline stage by stage and as a whole against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from test_dedup import brute_components, brute_exact, brute_print
from test_mixing import brute_targets

tiktoken = pytest.importorskip("tiktoken")


def corpus():
    rng = random.Random(12)
    rows = []
    for i in range(120):
        words = ["".join(rng.choices(["an", "er", "th", "ou", "ing"], k=rng.randrange(1, 4))) for _ in range(rng.randrange(1, 90))]
        rows.append((i, " ".join(w + "***" if i % 6 == 0 else w for w in words), "en", f"src{i % 3}" if i % 7 else None, 1, i))
    rows += [(200 + i, rows[i][1].upper() if i % 2 else rows[i][1], None, "src1", None, None) for i in range(20)]
    rows += [(300 + i, rows[70 + i][1] + " end", None, "src2", None, None) for i in range(10)]
    return rows + [(400, None, None, None, None, None), (401, "", "", "", 0, 0), (402, "a" * 5000 + " b" * 9000, "en", "src0", 0, 0)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT, size INT"
    spark.createDataFrame(corpus(), schema).repartition(3).write.parquet(str(path / "documents.parquet"))
    labels = [(i, int(i % 6 != 0), 0) for i in range(0, 120, 3)]
    spark.createDataFrame(labels, "doc_id BIGINT, quality INT, toxic INT").write.parquet(str(path / "labels.parquet"))
    return str(path)


def test_stages(spark, folder):
    import base64

    import public_tokenizers

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = {r.doc_id: tuple(r) for r in docs.collect()}
    frames = [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], folder).cache())
    good, equal, near, mixed, ids = frames[1:]
    for frame in (good, equal, near, mixed):
        assert frame.columns == docs.columns
        assert all(rows[r.doc_id] == tuple(r) for r in frame.collect())
    kept = [tuple(r) for r in good.collect()]
    assert len([r for r in kept if r[0] < 120 and r[0] % 6 == 0]) <= 8 and len([r for r in kept if r[0] < 120 and r[0] % 6]) > 90
    stay = sorted(k[0] for k in brute_exact(kept) if k[3])
    assert sorted(r.doc_id for r in equal.collect()) == stay
    groups = brute_components([(i, brute_print(rows[i][1])) for i in stay])
    assert {r.doc_id for r in near.collect()} == {low for _, _, low in groups}

    sizes = defaultdict(int)
    for r in near.collect():
        sizes[r.source] += len(re.findall(r"[^\x20\x09-\x0D]+", r.text or ""))
    taken, times = defaultdict(int), Counter(r.doc_id for r in mixed.collect())
    for doc_id, n in times.items():
        assert n <= 3
        taken[rows[doc_id][3]] += n * len(re.findall(r"[^\x20\x09-\x0D]+", rows[doc_id][1]))
    for source, aim in brute_targets(sizes).items():
        assert abs(taken[source] - aim) <= 40

    with open(public_tokenizers.path(corpus_pipeline.BPE_RANKS), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = Counter()
    for r in ids.collect():
        want = plain.encode_ordinary(rows[r.doc_id][1])
        assert r.ids == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        found[r.doc_id] += 1
    assert found == times

    whole = corpus_pipeline.run(spark, folder)
    assert whole.columns == ids.columns and Counter(r.doc_id for r in whole.collect()) == times


def test_empty_tables(spark, no_docs, folder):
    frame = no_docs
    for _, stage in corpus_pipeline.STAGES:
        frame = stage(spark, frame, folder)
    assert frame.collect() == []
