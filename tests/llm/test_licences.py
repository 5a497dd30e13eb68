"""Licence families on paragraphs in other words, near misses, and plain text."""

import random
import re

import pytest
from pyspark.sql import functions as F
from scanlake.llm import licences

NOTICES = {
    "mit": ["Released under the MIT License.", "the MIT license applies: released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software\nand associated documentation files (the \"Software\"), to deal in the Software without restriction,\nincluding without limitation the rights to use, copy, modify, merge, publish, distribute,\nsublicense, and/or sell copies of the Software."],
    "apache": ["Licensed under the Apache License, Version 2.0.", "// Licensed under the APACHE LICENSE, Version 2.0 (see file)"],
    "gpl": ["This work is licensed under the GNU General Public License, version 3."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0."],
    "cc-by": ["Licensed under CC BY 4.0."],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"],
    "proprietary": ["Copyright 2020 Someone. All rights reserved."],
}
CLEAN = ["He lost his licence to drive, and the warranty of the car too.", "The permission slip was signed by both parents.", "Copyright is a matter for lawyers, not for a Sunday walk."]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    prose = lambda n: " ".join("".join(rng.choices(["an", "er", "th", "ou", "ing"], k=rng.randrange(1, 4))) for _ in range(n))
    rows, want = [], {}
    for i in range(80):
        rows.append((i, prose(50) + "\n" + prose(20)))
        want[i] = set()
    for family, texts in NOTICES.items():
        for text in texts:
            i = len(rows)
            rows.append((i, f"{prose(30)}\n\n{text}\n\n{prose(40)}"))
            want[i] = {family}
    for text in CLEAN:
        want[len(rows)] = set()
        rows.append((len(rows), f"{prose(10)}\n{text}"))
    i = len(rows)
    rows.append((i, prose(20) + "\nReleased under the MIT License.\n" + prose(30_000) + "\nLicensed under CC BY-NC 4.0."))
    want[i] = {"mit", "cc-by-nc"}
    rows += [(1000, None), (1001, ""), (None, "Released under the MIT License."), rows[85]]
    want |= {1000: set(), 1001: set(), None: {"mit"}}
    return rows, want, spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("families", F.lit("x")).repartition(3)


def test_families(corpus):
    rows, want, docs = corpus
    found = licences.scanned(docs).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in rows)
    wrong = [(r.doc_id, r.families) for r in found if set(r.families) != want[r.doc_id]]
    assert len(wrong) <= 1, wrong  # of other wordings one may stay unknown
    assert not [w for w in wrong if w[1]], "a family that is not there"
    for r in found:
        assert r.n_confirmed <= r.n_predicted <= r.n_paragraphs and 0 <= r.score <= 1
        assert bool(r.families) == (r.n_confirmed > 0)


def test_paragraphs_against_plain_code(spark, corpus):
    rows, _, docs = corpus
    found = docs.select("text", licences.paragraphs(F.col("text")).alias("p")).collect()
    for r in found:
        text = r.text or ""
        units = text.split("\n") + [b for b in re.split(r"\n[ \t\r]*\n", text) if "\n" in b]
        assert set(r.p) == {u for u in units if any(a in u.lower() for a in licences.ANCHORS)}


def test_no_python_on_executors(spark, corpus):
    plan = licences.scanned(corpus[2])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_odd_tables(odd_docs, no_docs):
    assert licences.scanned(no_docs).collect() == []
    found = licences.scanned(odd_docs).collect()
    assert len(found) == odd_docs.count() and not any(r.families for r in found)


def test_notices_within_long_lines_and_over_lines(spark):
    """A notice in the middle of a long line, of a text of one line, and wrapped at any word."""
    rng = random.Random(12)
    plain = lambda n: " ".join("".join(rng.choices(["an", "er", "th", "ou", "ing"], k=rng.randrange(1, 4))) for _ in range(n))
    notices = {"mit": "Released under the MIT License.", "apache": "Licensed under the Apache License, Version 2.0", "gpl": "SPDX-License-Identifier: GPL-3.0-or-later"}
    rows, want = [], []
    for family, notice in notices.items():
        for i in range(12):
            tokens = notice.split(" ")
            cut = 1 + i % max(1, len(tokens) - 1)
            wrapped = " ".join(tokens[:cut]) + "\n" + " ".join(tokens[cut:]) if i % 3 == 0 else notice
            rows.append((len(rows), f"{plain(60 + 25 * (i % 4))} {wrapped} {plain(80)}"))
            want.append([family])
    for _ in range(30):
        rows.append((len(rows), plain(300)))
        want.append([])
    found = {r.doc_id: r.families for r in licences.scanned(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(3)).collect()}
    right = sum(found[i] == want[i] for i in range(36))
    assert right >= 33, [(rows[i], found[i]) for i in range(36) if found[i] != want[i]][:3]
    assert not any(found[i] for i in range(36, len(rows)))


def test_no_text_without_a_key_pair_can_be_confirmed():
    keys = {pair for pair, _, _ in licences.key_pairs()}
    for template in (t for texts in licences.TEMPLATES.values() for t in texts):
        tokens = [w for w in re.split("[^a-z0-9]+", template.lower()) if w]
        wanted = {f"{a} {b}" for a, b in zip(tokens, tokens[1:])}
        assert len(wanted - keys) / len(wanted) < licences.COVERED
