"""Language of a text by a bidirectional gated recurrent network over its bytes.

The whole text is cut into windows of ``WINDOW`` bytes; the network gives class
probabilities at every byte, and the document's probabilities are their mean. The most
probable language is the prediction, its probability the score.

Training is on the driver, in numpy, by backpropagation through time, on at most
``SAMPLES`` pieces of ``PIECE`` characters per language (for each of as many hash buckets
the document with the smallest hash), and on the ``LANGUAGES`` most frequent languages at
most. Only text and language of the training fold are read.

Defined cases: a null text or one without a letter is ``und`` with score 0, and so is
every text if nothing was learned; null languages are not learned; a null doc_id belongs
to the training fold; repeated rows repeat; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.llm import gru
from scanlake.llm.common import ready

WINDOW, BLOCK = 64, 1024
HIDDEN, EPOCHS, SEED = 12, 5, 3
SAMPLES, PIECE, LANGUAGES = 96, 1200, 256
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def windows_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of all texts (a row each), which of their bytes are text, and each row's text."""
    counts = [-(-len(t) // WINDOW) for t in texts]
    data = np.zeros((sum(counts), WINDOW), np.uint8)
    used = np.zeros((sum(counts), WINDOW), bool)
    flat, row = data.reshape(-1), 0
    for text, count in zip(texts, counts):
        flat[row * WINDOW : row * WINDOW + len(text)] = np.frombuffer(text, np.uint8)
        used.reshape(-1)[row * WINDOW : row * WINDOW + len(text)] = True
        row += count
    return data, used, np.repeat(np.arange(len(texts)), counts)


def document_probabilities(model: dict[str, np.ndarray], texts: list[bytes]) -> np.ndarray:
    """Mean class probabilities over all bytes of each text."""
    classes = len(model["out_0"])
    total = np.zeros((len(texts), classes))
    data, used, owner = windows_of(texts)
    for start in range(0, len(data), BLOCK):
        part = slice(start, start + BLOCK)
        found = gru.probabilities(gru.position_scores(model, data[part]))
        found *= used[part].T[:, :, None]
        np.add.at(total, owner[part], found.sum(axis=0))
    return total / np.maximum(1, [[len(t)] for t in texts]) if texts else total


def training_pieces(docs: DataFrame, doc_id: str, text: str, lang: str) -> list[tuple[str, str]]:
    """Language and piece of at most SAMPLES documents per language of the training fold."""
    hashed = F.xxhash64(F.col(doc_id).cast("string"), F.length(text))
    start = F.pmod(F.xxhash64(hashed), F.greatest(F.length(text) - PIECE, F.lit(0)) + 1).cast("int") + 1
    rows = docs.where(F.col(lang).isNotNull() & (F.length(text) > 0) & ~held_out(F.col(doc_id))).select(
        F.col(lang).cast("string").alias("lang"),
        F.pmod(hashed, F.lit(SAMPLES)).alias("bucket"),
        F.struct(hashed.alias("h"), F.substr(F.col(text), start, F.lit(PIECE)).alias("piece")).alias("one"),
    )
    frequent = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    known = rows.join(F.broadcast(frequent.select("lang")), "lang")  # LANGUAGES rows at most
    picked = known.groupBy("lang", "bucket").agg(F.min("one").alias("one"))
    return [(r["lang"], r["piece"]) for r in picked.select("lang", "one.piece", "bucket").orderBy("lang", "bucket").collect()]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> tuple[dict[str, np.ndarray], list[str]]:
    """The trained network and the languages of its classes."""
    pieces = training_pieces(docs, doc_id, text, lang)
    names = sorted({name for name, _ in pieces})
    if not names:
        return gru.new_model(HIDDEN, 1, SEED), []
    data, used, owner = windows_of([piece.encode() for _, piece in pieces])
    labels = np.array([names.index(name) for name, _ in pieces])[owner]
    return gru.train(data, used, labels, HIDDEN, len(names), EPOCHS, SEED), names


ROW = "doc_id BIGINT, held_out BOOLEAN, lang_pred STRING, score DOUBLE"


class Predict:
    def __init__(self, model: dict[str, np.ndarray], names: list[str]):
        self.model, self.names = model, names

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                texts = part.column(2).to_pylist()
                known = [i for i, text in enumerate(texts) if self.names and text and any(map(str.isalpha, text))]
                found = document_probabilities(self.model, [texts[i].encode() for i in known])
                langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                for i, row in zip(known, found):
                    best = int(row.argmax())
                    langs[i], scores[i] = self.names[best], min(1.0, row[best])
                columns = [part.column(0), part.column(1), pa.array(langs, pa.string()), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held_out", "lang_pred", "score"])


def languages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", model=None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    ready(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
    network, names = model or fit(narrow)
    rows = narrow.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(Predict(network, names), ROW)
