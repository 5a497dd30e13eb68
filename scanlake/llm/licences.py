"""Licence families of documents: a paragraph classifier confirmed by templates.

Everything is DataFrame, SQL and JVM machine-learning code; no Python runs on executors.

* *Paragraphs* are lines and blank-line blocks with an anchor word (``ANCHORS``), and, of the
  words of the whole text whatever its lines, stretches where a template may lie: a text can
  only be confirmed for a template if it holds one of its ``key_pairs``, so each place of
  one gives the stretch of the template's length around it, tight and wide.
* *Classifier*: multinomial logistic regression with elastic-net penalty over hashed word
  1- and 2-grams, trained on variants of the templates (words left out, cut ends) and, for
  the class ``unknown``, on near misses and on lines of at most ``SAMPLE`` documents.
* *Calibration*: every fourth variant is left out of training; a family is predicted only
  if its probability and that of not being unknown exceed what 99 of 100 left-out unknown
  paragraphs reach (and one half).
* *Confirmation*: the paragraph must hold at least ``COVERED`` of the word pairs of a
  template of the predicted family.

Defined cases: a null or empty text has no families; repeated rows repeat; a null doc_id
is carried along; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm.common import ready, written
from scanlake.operators.joins import lookup_join

UNKNOWN = "unknown"
FEATURES = 1 << 13
SAMPLE, SEED = 120, 9
COVERED = 0.6
VARIANTS = 12

# Words of licence paragraphs, and notices and clauses of well-known licences.
ANCHORS = ("licen", "copyright", "warrant", "permission", "redistribut", "creative commons", "public domain", "rights reserved", "copyleft", "cc by", "cc-by", "cc0")

TEMPLATES = {
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "This project is licensed under the terms of the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "SPDX-License-Identifier: MIT",
    ],
    "bsd": [
        "Released under the BSD License",
        "Licensed under the 3-Clause BSD License",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied",
        "Released under the Apache 2.0 license",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "Licensed under the GNU General Public License, version 2",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU General Public License along with this program",
        "Licensed under the GNU Lesser General Public License",
        "Licensed under the GNU Affero General Public License",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
        "Licensed under the Mozilla Public License, Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "Dedicated to the public domain under CC0 1.0 Universal",
    ],
    "proprietary": [
        "Copyright. All rights reserved",
        "No part of this publication may be reproduced, distributed, or transmitted in any form without the prior written permission of the publisher",
    ],
}

NEAR_MISSES = [
    "He showed the officer his driving license at the gate",
    "The license plate of the car was covered with mud",
    "She asked for permission to leave the room early",
    "The warranty of the washing machine ended in the spring",
    "Fishing without a license is forbidden on this lake",
    "The copyright of the song was sold for a large sum",
    "A warrant was issued for the arrest of the two men",
    "Poetic license lets a writer bend the rules of grammar",
    "They redistributed the seats among the smaller parties",
    "The museum keeps works that are in the public domain on its second floor",
    "The city gave the bar a license to sell wine until midnight",
    "Permission was granted to build the house near the river",
    "A software license can cost more than the machine it runs on",
    "The general spoke to the public about the new law",
    "The lawyers argued about copyright law for a week",
    "Version two of the plan was agreed without conditions",
]


def anchored(text: Column) -> Column:
    lower = F.lower(text)
    hit = F.contains(lower, F.lit(ANCHORS[0]))
    for anchor in ANCHORS[1:]:
        hit = hit | F.contains(lower, F.lit(anchor))
    return hit


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda w: w != "")


def pairs(tokens: Column) -> Column:
    last = F.size(tokens) - 1
    return F.when(last > 0, F.transform(F.sequence(F.lit(0), last - 1), lambda i: F.concat_ws(" ", F.get(tokens, i), F.get(tokens, i + 1)))).otherwise(
        F.array().cast("array<string>")
    )


def featured(rows: DataFrame) -> DataFrame:
    """Rows of column ``words`` with the hashed, normalised features."""
    grams = rows.withColumn("grams", F.concat("words", pairs(F.col("words"))))
    hashed = HashingTF(numFeatures=FEATURES, binary=True, inputCol="grams", outputCol="counted").transform(grams)
    return Normalizer(inputCol="counted", outputCol="features").transform(hashed).drop("grams", "counted")


def family_names() -> list[str]:
    return [UNKNOWN, *TEMPLATES]


def templates(spark: SparkSession) -> DataFrame:
    rows = [(at, family, text) for at, (family, text) in enumerate((f, t) for f, ts in TEMPLATES.items() for t in ts)]
    return spark.createDataFrame(rows, "template INT, family STRING, text STRING")


def training_rows(docs: DataFrame, text: str, doc_id: str) -> DataFrame:
    """label, words and whether a row is left out for calibration."""
    spark = docs.sparkSession
    misses = spark.createDataFrame([(-1 - i, UNKNOWN, t) for i, t in enumerate(NEAR_MISSES)], "template INT, family STRING, text STRING")
    variant = F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1)))
    made = templates(spark).union(misses).select("template", "family", words(F.col("text")).alias("all"), variant.alias("variant"))
    # The first variant is the template itself; others lose a tenth of the words, or an end of long ones.
    lost = F.filter("all", lambda w, i: F.pmod(F.xxhash64(w, i, F.col("variant"), F.lit(SEED)), F.lit(10)) != 0)
    long = F.size("all")
    cut = F.when((long > 16) & (F.col("variant") % 2 == 1), F.slice(lost, F.least(F.col("variant"), F.lit(6)), long)).otherwise(lost)
    kept = F.when(F.col("variant") == 0, F.col("all")).otherwise(cut)
    made = made.select("family", kept.alias("words"), (F.col("variant") % 4 == 3).alias("left_out"))
    # Of each of SAMPLE buckets the document with the smallest hash, of it eight lines.
    hashed, lines = F.xxhash64(F.col(doc_id).cast("string"), F.length(text)), F.transform(F.split(text, "\n"), lambda line: F.left(line, F.lit(400)))
    one = F.struct(hashed.alias("h"), F.slice(lines, 1, 8).alias("lines"))
    sample = docs.where(F.length(text) > 0).groupBy(F.pmod(hashed, F.lit(SAMPLE)).alias("bucket")).agg(F.min(one).alias("one"))
    lines = sample.select("one.h", F.explode("one.lines").alias("line")).where(~anchored(F.col("line")))
    plain = lines.select(F.lit(UNKNOWN).alias("family"), words(F.col("line")).alias("words"), (F.pmod("h", F.lit(4)) == 3).alias("left_out"))
    names = F.array(*[F.lit(n) for n in family_names()])
    return made.union(plain).where(F.size("words") > 0).select((F.array_position(names, F.col("family")) - 1).cast("double").alias("label"), "words", "left_out")


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[LogisticRegressionModel, float]:
    """The classifier and the calibrated limit on the probability of not being unknown."""
    # Some thousand short rows, whatever the input.
    rows = featured(written(training_rows(docs, text, doc_id).coalesce(1), "licence-training"))
    share = F.count(F.lit(1))
    sizes = {r["label"]: r["n"] for r in rows.where("NOT left_out").groupBy("label").agg(share.alias("n")).collect()}
    weight = F.element_at(F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, 1.0 / n)]), F.col("label")) * (sum(sizes.values()) / len(sizes))
    regression = LogisticRegression(maxIter=25, regParam=3e-4, elasticNetParam=0.1, standardization=False, family="multinomial", weightCol="weight")
    model = regression.fit(rows.where("NOT left_out").withColumn("weight", weight))
    sure = 1 - F.get(vector_to_array("probability"), F.lit(0))
    unknown = model.transform(rows.where("left_out AND label = 0")).agg(F.percentile(sure, F.lit(0.99))).first()[0]
    return model, max(0.5, unknown or 0.0)


def paragraphs(text: Column) -> Column:
    """Lines and blank-line blocks of a text that hold an anchor."""
    both = F.concat(F.split(text, "\n"), F.filter(F.split(text, r"\n[ \t\r]*\n"), lambda b: F.contains(b, F.lit("\n"))))
    found = F.when(anchored(text), F.array_distinct(F.filter(both, anchored)))
    return F.coalesce(found, F.array().cast("array<string>"))


def key_pairs() -> list[tuple[str, int, int]]:
    """(pair, place of the pair in its template, words of the template).

    Of each template so many word pairs that no text without one of them can hold COVERED
    of all; the longest ones, as they are rare in other texts.
    """
    keys = []
    for template in (t for texts in TEMPLATES.values() for t in texts):
        tokens = [w for w in re.split("[^a-z0-9]+", template.lower()) if w]
        at = {}
        for place, pair in enumerate(zip(tokens, tokens[1:])):
            at.setdefault(" ".join(pair), place)
        needed = next(n for n in range(len(at) + 1) if n / len(at) >= COVERED)
        chosen = sorted(at, key=lambda pair: (-len(pair), pair))[: len(at) - needed + 1]
        keys += [(pair, at[pair], len(tokens)) for pair in chosen]
    return keys


def keyed(tokens: Column) -> Column:
    """The words of a text that holds a key pair, otherwise null."""
    keys = F.array(*[F.lit(pair) for pair in sorted({k[0] for k in key_pairs()})])
    return F.when(F.arrays_overlap(pairs(tokens), keys), tokens)


def stretches(texts: DataFrame) -> DataFrame:
    """row, at (negative) and words of each stretch of the given ``tokens`` in which a template may lie."""
    spark = texts.sparkSession
    # Places in the text without its words; a few hundred key pairs: a bounded broadcast.
    places = texts.select("row", F.posexplode(pairs(F.col("tokens"))).alias("place", "pair"))
    keys = spark.createDataFrame(key_pairs(), "pair STRING, offset INT, length INT")
    keys = keys.withColumn("slack", F.explode(F.array(F.floor(F.col("length") / 4).cast("int") + 2, F.col("length"))))
    hits = places.join(F.broadcast(keys), "pair")
    start = F.greatest(F.col("place") - F.col("offset") - F.col("slack"), F.lit(0))
    spans = hits.select("row", start.alias("start"), (F.col("length") + 2 * F.col("slack")).alias("length")).distinct()
    sliced = lookup_join(spans, texts.select("row", "tokens"), ["row"], "inner")
    at = -1 - F.col("start").cast("bigint") * 1024 - F.col("length")
    return sliced.select("row", at.alias("at"), F.slice("tokens", F.col("start") + 1, F.col("length")).alias("words"))


def scanned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, families (sorted array of confirmed ones), n_paragraphs
    (lines, blocks and stretches that were classified), n_predicted and n_confirmed of them,
    and the highest confirmed score."""
    spark = ready(docs.sparkSession)
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    model, limit = fit(named)
    found = named.select("doc_id", F.monotonically_increasing_id().alias("row"), "text", words(F.col("text")).alias("tokens"))
    found = written(found.select("doc_id", "row", paragraphs(F.col("text")).alias("paragraphs"), keyed(F.col("tokens")).alias("tokens")), "licence-paragraphs")
    units = found.where(F.size("paragraphs") > 0).select("row", F.posexplode("paragraphs").alias("at", "paragraph"))
    units = units.select("row", F.col("at").cast("bigint").alias("at"), words(F.col("paragraph")).alias("words"))
    units = written(units.union(stretches(found.where("tokens IS NOT NULL"))), "licence-words")
    chance = vector_to_array("probability")
    scored = model.transform(featured(units)).select("row", "at", "words", chance.alias("chance"))
    best = F.array_max(F.slice("chance", 2, len(TEMPLATES)))
    names = F.array(*[F.lit(n) for n in TEMPLATES])
    family = F.get(names, (F.array_position(F.slice("chance", 2, len(TEMPLATES)), best) - 1).cast("int"))
    sure = (1 - F.get("chance", F.lit(0)) > limit) & (best > 0.5)
    predicted = scored.select("row", "at", pairs(F.col("words")).alias("pairs"), best.alias("score"), F.when(sure, family).alias("family"))
    predicted = written(predicted, "licence-predictions")  # read twice below

    # Templates are a few dozen rows: a bounded broadcast.
    known = templates(spark).select(F.col("family").alias("known"), words(F.col("text")).alias("words"))
    known = known.select("known", F.array_distinct(pairs(F.col("words"))).alias("wanted"))
    compared = predicted.where("family IS NOT NULL").join(F.broadcast(known), F.col("family") == F.col("known"))
    covered = F.size(F.array_intersect("wanted", "pairs")) / F.size("wanted")
    confirmed = compared.where(covered >= COVERED).groupBy("row", "at").agg(F.first("family").alias("family"), F.first("score").alias("score"))
    by_row = predicted.groupBy("row").agg(F.count(F.lit(1)).alias("n_paragraphs"), F.count("family").alias("n_predicted"))
    sure_rows = confirmed.groupBy("row").agg(F.sort_array(F.collect_set("family")).alias("families"), F.count(F.lit(1)).alias("n_confirmed"), F.max("score").alias("score"))
    joined = found.select("doc_id", "row").join(by_row, "row", "left").join(sure_rows, "row", "left")
    return joined.select(
        "doc_id",
        F.coalesce("families", F.array().cast("array<string>")).alias("families"),
        F.coalesce("n_paragraphs", F.lit(0)).alias("n_paragraphs"),
        F.coalesce("n_predicted", F.lit(0)).alias("n_predicted"),
        F.coalesce("n_confirmed", F.lit(0)).alias("n_confirmed"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
