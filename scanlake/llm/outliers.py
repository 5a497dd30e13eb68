"""Quality rules, and robust multivariate outliers among the documents that pass them.

A document fails the base rules with under ``FEWEST`` words or with over half of its
words in repeated three-word windows. The others are judged by five transformed
statistics (logs of words and of their mean length, logs of the shares of symbols, repeated
lines and repeated words) against a minimum-covariance-determinant estimate of their
language and source; a document is rejected if its squared Mahalanobis distance is beyond
the chi-squared quantile ``CUT``.

All rows are folded once to cells of a fixed grid: count, sums and products by group and
cell. Statistics are whole numbers (1/``UNIT``), so sums are exact and reruns agree, and
the grid bounds what a group can have, whatever its rows. The estimate of a group works on
its cells alone: concentration steps take the half of the rows with the least distances, a
cell at the limit in part, from medians and from ``STARTS`` random starts, until the
determinant falls no more; the start with the least determinant wins. Its covariance is
scaled to the median distance that it should have, rows within the 0.975 quantile give the
final (reweighted) estimate, which is nowhere narrower than ``FLOORS``, the steps in which
a text of usual length can be measured. One pass over all rows then gives each
document its own distance, from its own statistics.

Groups of under ``LEAST`` rows are judged by the estimate of their whole language, and
languages of under ``LEAST`` by that of all rows; of fewer rows only the base rules count.
An estimate has 20 numbers from half of its rows; with fewer than 60 rows that is 1.5 rows a
number, and in trials more than a twentieth of clean documents was then rejected.

Defined cases: a null text has no words and fails; null languages and sources are groups
like others; repeated rows count as often as they come; a group without spread is held
to the floors ``FLOORS``; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import ready
from scanlake.llm.tables import Tables
from scanlake.operators.joins import lookup_join

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
FEWEST, REPEATED = 50, 50
BLANK = re.compile(r"[\x20\x09-\x0D]*\Z")

SIZE = 5
UNIT = 1024
#: Steps in which statistics can be told apart: one word in ten, one symbol in some 150 words,
#: one repeated line or word in 90. A third of a text repeated is over four such steps.
FLOORS = (0.1, 0.1, 0.5, 0.75, 0.75)
#: Width of a cell in each statistic, in units.
WIDTHS = (128, 64, 256, 256, 256)
LEAST, STARTS, FIRST_STEPS = 60, 24, 2
#: Upper 0.001 quantile, 0.975 quantile and median of chi-squared with five degrees of freedom.
CUT, NEAR, MIDDLE = 20.515, 12.833, 4.351
#: What the covariance of rows within NEAR is short of.
SHORT_OF = 1.0555


def statistics(text: str | None) -> tuple[int, int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and the lines with a word."""
    text = text or ""
    words = text.encode().split()  # parts at 0x20 and 0x09-0x0D
    chars = len(text) - sum(map(text.count, SPACE))
    seen: set[str] = set()
    repeated = lines = 0
    for line in text.split("\n"):
        if not BLANK.match(line):
            lines += 1
            repeated += line in seen
            seen.add(line)
    windows: dict[tuple, int] = {}
    places = list(zip(words, words[1:], words[2:]))
    for window in places:
        windows[window] = windows.get(window, 0) + 1
    inside = 0
    if len(windows) < len(places):
        last = -1  # the last word that is counted already
        for i, window in enumerate(places):
            if windows[window] > 1:
                inside += i + 2 - max(last, i - 1)
                last = i + 2
    return len(words), chars, sum(map(text.count, SYMBOLS)), repeated, inside, lines


ROW = "doc_id BIGINT, lang STRING, source STRING, n_words BIGINT, word_chars BIGINT, n_symbols BIGINT, n_dup_lines BIGINT, n_repeat_words BIGINT, n_lines BIGINT"


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = np.array([statistics(text.as_py()) for text in batch.column(3)], np.int64).reshape(-1, 6)
        columns = list(batch.columns[:3]) + [pa.array(found[:, i]) for i in range(6)]
        yield pa.RecordBatch.from_arrays(columns, names=[field.split()[0] for field in ROW.split(", ")])


def transformed() -> list[Column]:
    """The five statistics in units of 1/UNIT."""
    words = F.greatest("n_words", F.lit(1))
    share = lambda n, of: F.log1p(F.lit(100.0) * F.col(n) / of)
    values = [
        F.log1p("n_words"),
        F.log1p(F.col("word_chars") / words),
        share("n_symbols", words),
        share("n_dup_lines", F.greatest("n_lines", F.lit(1))),
        share("n_repeat_words", words),
    ]
    return [F.round(v * UNIT).cast("bigint").alias(f"x{i}") for i, v in enumerate(values)]


def grouped(rows: DataFrame) -> DataFrame:
    """Rows with the estimates they may be judged by: of their language and source, of the language, of all."""
    part = lambda c: F.coalesce(F.concat(F.lit("v"), F.col(c)), F.lit("n"))
    own = F.concat(part("lang"), F.lit("\x1f"), part("source"))
    return rows.withColumns({"own": own, "wide": F.concat(F.lit("l"), part("lang")), "rest": F.lit("a")})


CELL = [f"c{i}" for i in range(SIZE)]
UPPER = [(i, j) for i in range(SIZE) for j in range(i, SIZE)]
MOMENTS = ["n", *[f"s{i}" for i in range(SIZE)], *[f"q{i}{j}" for i, j in UPPER]]


def folded(rows: DataFrame) -> DataFrame:
    """Count, sums and products of the rows of each group and cell."""
    cell = [F.floor(F.col(f"x{i}") / width).cast("int").alias(name) for i, (name, width) in enumerate(zip(CELL, WIDTHS))]
    sums = [F.sum(f"x{i}").alias(f"s{i}") for i in range(SIZE)]
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")).alias(f"q{i}{j}") for i, j in UPPER]
    return rows.groupBy("own", "wide", "rest", *cell).agg(F.count(F.lit(1)).alias("n"), *sums, *products)


def keys_of(cells: DataFrame) -> DataFrame:
    """Each group with the key of the estimate that judges it, null if there are too few rows in all."""
    groups = cells.groupBy("own", "wide", "rest").agg(F.sum("n").alias("n"))
    for name in ("wide", "rest"):
        groups = lookup_join(groups, groups.groupBy(name).agg(F.sum("n").alias(f"n_{name}")), [name], "inner")
    enough = lambda n: F.col(n) >= LEAST
    key = F.when(enough("n"), F.col("own")).when(enough("n_wide"), F.col("wide")).when(enough("n_rest"), F.col("rest"))
    return groups.select("own", key.alias("key"))


def cells_of_estimates(cells: DataFrame, keys: DataFrame) -> DataFrame:
    """Cells by estimate: a group's own, those of its language and those of all add up where they are needed."""
    needed = keys.where("key IS NOT NULL").select("key").distinct()
    each = cells.withColumn("key", F.explode(F.array("own", "wide", "rest")))  # of cells, not of rows
    used = lookup_join(each, needed.withColumn("used", F.lit(True)), ["key"], "inner")
    return used.groupBy("key", *CELL).agg(*[F.sum(m).alias(m) for m in MOMENTS])


def _x(i: int) -> Column:
    return F.col(f"x{i}") / UNIT


def squared_distance() -> Column:
    off = [_x(i) - F.col(f"m{i}") for i in range(SIZE)]
    terms = [(1 if i == j else 2) * off[i] * off[j] * F.col(f"p{i}{j}") for i in range(SIZE) for j in range(i, SIZE)]
    return F.when(F.col("m0").isNotNull(), F.greatest(sum(terms[1:], terms[0]), F.lit(0.0)))


class Cells(NamedTuple):
    """Cells of a group in a fixed order: rows, their sum and their products."""

    n: np.ndarray
    sums: np.ndarray
    products: np.ndarray

    def moments(self, taken: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Center and covariance of the rows taken, a share of each cell."""
        rows = float(taken @ self.n)
        center = taken @ self.sums / rows
        return center, np.einsum("c,cij->ij", taken, self.products) / rows - np.outer(center, center)

    def distances(self, center: np.ndarray, cov: np.ndarray) -> np.ndarray:
        """Mean squared distance of each cell's rows."""
        inverse = np.linalg.inv(cov)
        own = np.einsum("ij,cij->c", inverse, self.products) - 2 * self.sums @ inverse @ center
        return np.maximum(own / self.n + center @ inverse @ center, 0.0)

    def nearest(self, distances: np.ndarray, rows: float) -> np.ndarray:
        """The share of each cell among that many nearest rows; the last cell is taken in part."""
        order = np.argsort(distances, kind="stable")
        before = np.concatenate([[0], np.cumsum(self.n[order])[:-1]])
        taken = np.empty(len(order))
        taken[order] = np.clip((rows - before) / self.n[order], 0, 1)
        return taken


def floored(cov: np.ndarray) -> np.ndarray:
    """Covariance that is nowhere narrower than the floors: in their units no eigenvalue is below 1."""
    unit = np.outer(FLOORS, FLOORS)
    values, vectors = np.linalg.eigh(cov / unit)
    return (vectors * np.maximum(values, 1.0)) @ vectors.T * unit


def concentrate(cells: Cells, center: np.ndarray, cov: np.ndarray, most: int | None = None) -> tuple[float, np.ndarray, np.ndarray]:
    """Log determinant, center and covariance of the nearest half, step by step until the determinant stays."""
    half = (cells.n.sum() + SIZE + 1) // 2
    best = (np.inf, center, cov)
    while most is None or most > 0:
        center, cov = cells.moments(cells.nearest(cells.distances(best[1], best[2]), half))
        cov = floored(cov)
        size = np.linalg.slogdet(cov)[1]
        if size >= best[0] - 1e-9:
            break
        best, most = (size, center, cov), None if most is None else most - 1
    return best


def weighted_median(values: np.ndarray, weights: np.ndarray) -> float:
    order = np.argsort(values, kind="stable")
    return float(values[order][np.searchsorted(np.cumsum(weights[order]), weights.sum() / 2)])


def estimate(cells: Cells) -> tuple[np.ndarray, np.ndarray]:
    """Reweighted minimum-covariance-determinant estimate of a group."""
    means = cells.sums / cells.n[:, None]
    middle = np.array([weighted_median(m, cells.n) for m in means.T])
    spread = np.array([1.4826 * weighted_median(np.abs(m - c), cells.n) for m, c in zip(means.T, middle)])
    starts = [(middle, floored(np.diag(spread**2)))]
    rng = np.random.default_rng(1)
    for _ in range(STARTS):
        drawn = np.minimum(np.bincount(rng.choice(len(means), SIZE + 1, p=cells.n / cells.n.sum()), minlength=len(means)) / cells.n, 1.0)
        center, cov = cells.moments(drawn)
        starts.append((center, floored(cov)))
    tried = sorted((concentrate(cells, *start, FIRST_STEPS) for start in starts), key=lambda t: t[0])
    _, center, cov = min((concentrate(cells, c, v) for _, c, v in tried[:5]), key=lambda t: t[0])
    cov = cov * max(1.0, weighted_median(cells.distances(center, cov), cells.n) / MIDDLE)
    center, cov = cells.moments((cells.distances(center, cov) <= NEAR).astype(float))
    return center, floored(cov * SHORT_OF)


ESTIMATE = "key STRING, " + ", ".join([f"m{i} DOUBLE" for i in range(SIZE)] + [f"p{i}{j} DOUBLE" for i, j in UPPER])


def _estimate(frame: pd.DataFrame) -> pd.DataFrame:
    """Cells of a group, as many as the grid has at most, to center and inverse covariance."""
    frame = frame.sort_values(CELL)
    products = np.empty((len(frame), SIZE, SIZE))
    for i, j in UPPER:
        products[:, i, j] = products[:, j, i] = frame[f"q{i}{j}"].to_numpy(float) / UNIT**2
    sums = np.column_stack([frame[f"s{i}"].to_numpy(float) / UNIT for i in range(SIZE)])
    center, cov = estimate(Cells(frame["n"].to_numpy(float), sums, products))
    inverse = np.linalg.inv(cov)
    row = [frame["key"].iloc[0], *np.round(center, 9), *[round(inverse[i, j], 9) for i, j in UPPER]]
    return pd.DataFrame([row], columns=["key", *[f"m{i}" for i in range(SIZE)], *[f"p{i}{j}" for i, j in UPPER]])


def judged(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per document: its statistics, base_failed, distance (null if not judged) and kept."""
    ready(docs.sparkSession)
    named = [F.col(doc_id).cast("bigint").alias("doc_id"), *[F.col(c).cast("string").alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))]]
    failed = (F.col("n_words") < FEWEST) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    with Tables(docs.sparkSession, "outliers") as tables:
        counted = tables.written(docs.select(*named).mapInArrow(_count, ROW).withColumn("base_failed", failed).select("*", *transformed()), "text-statistics")
        passed = grouped(counted.where("NOT base_failed"))
        cells = tables.written(folded(passed), "cells")
        keys = tables.written(keys_of(cells), "keys")
        fitted = tables.written(cells_of_estimates(cells, keys).groupBy("key").applyInPandas(_estimate, ESTIMATE), "estimates")
        judges = lookup_join(keys, fitted, ["key"], "inner").drop("key")
        statistics_ = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
        good = lookup_join(passed, judges, ["own"]).select(*statistics_, squared_distance().alias("distance"))
        good = good.withColumn("kept", F.coalesce(F.col("distance") <= CUT, F.lit(True)))
        bad = counted.where("base_failed").select(*statistics_, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))
        return tables.result(good.union(bad))
