"""Secrets: three fixed patterns, and strings that pass as random for their length.

A candidate is a run of at least ``SHORTEST`` letters, digits and ``+/_-`` outside the
pattern matches. Its encoding is inferred as the narrowest alphabet that holds it, and a
battery is run on its symbols: chi-squared uniformity over groups of the alphabet, a runs
test about the middle of the alphabet, and lag-one serial correlation. The statistic is
the sum of squares of the three normal scores (of chi-squared only excess counts); for a
random string it is near chi-squared with three degrees of freedom.

Ordinary text is the null hypothesis: what is neither in a pattern match nor in a run as
long as a candidate, so that random strings of one source never hide those of others. All
documents, the rest taken out with the white space, are cut into windows of each length class, and the same battery over them gives the distribution of
the statistic by length. A candidate's p-value is the share of windows of its class that
look as random. The Benjamini-Hochberg rule over the candidates of all documents then
bounds the share of false discoveries; a candidate that fails as random is never taken.

Statistics are counted by length class and bin, so the driver sees two small tables.

Defined cases: a null text is empty; offsets are code points; rows are treated one by
one, so repeated rows repeat; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scanlake.llm.common import ready, written

# The patterns of the base scan.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

SHORTEST = 20
#: Lengths of the windows of ordinary text; a candidate belongs to the last one not longer than it.
CLASSES = (20, 28, 40, 64)
BIN, BINS = 0.25, 512
#: Bound on the share of false discoveries, and the statistic above which a string is not random
#: (one in a thousand of chi-squared with three degrees of freedom).
RATE, NOT_RANDOM = 0.05, 16.27

# Encodings from narrow to wide: name and alphabet in the order of its values.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
ENCODINGS = (
    ("decimal", DIGITS),
    ("hex", DIGITS + "abcdef"),
    ("HEX", DIGITS + "ABCDEF"),
    ("lower", LOWER),
    ("upper", UPPER),
    ("base32", UPPER + "234567"),
    ("base36", DIGITS + LOWER),
    ("BASE36", DIGITS + UPPER),
    ("base62", UPPER + LOWER + DIGITS),
    ("base64", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", UPPER + LOWER + DIGITS + "-_"),
    ("mixed", UPPER + LOWER + DIGITS + "+/-_"),
)
#: Letters that prose uses much, somewhat and little; together with digits the groups of the uniformity test.
GROUPS = ("aeiou", "tnsrhld", "cmfpgw", "ybvkxjqz")


def _tables() -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Which encodings hold a byte (as bits); per encoding its values, groups and group shares."""
    holds, values, groups, shares = np.zeros(256, np.int16), [], [], []
    for at, (_, alphabet) in enumerate(ENCODINGS):
        codes = np.frombuffer(alphabet.encode(), np.uint8)
        holds[codes] |= 1 << at
        value = np.zeros(256, np.float32)
        value[codes] = np.arange(len(codes))
        parts: dict[str, list[int]] = {}
        for symbol in alphabet:
            lower = symbol.lower()
            name = "digit" + str(int(symbol) // 5) if symbol.isdigit() else next((g for g in GROUPS if lower in g), "sign")
            if symbol.isalpha() and len(alphabet) > 36 and name in GROUPS:
                name += "U" if symbol.isupper() else "l"
            parts.setdefault(name, []).append(ord(symbol))
        group = np.zeros(256, np.int32)
        for i, members in enumerate(parts.values()):
            group[members] = i
        values.append(value)
        groups.append(group)
        shares.append(np.array([len(m) for m in parts.values()]) / len(alphabet))
    return holds, values, groups, shares


HOLDS, VALUES, GROUP_OF, SHARES = _tables()


def infer(windows: np.ndarray) -> np.ndarray:
    """Index of the narrowest encoding of each row of bytes; -1 for none."""
    common = np.bitwise_and.reduce(HOLDS[windows], axis=1)
    lowest = common & -common
    return np.where(lowest > 0, np.log2(np.maximum(lowest, 1)).astype(np.int64), -1)


def battery(windows: np.ndarray, encoding: int) -> np.ndarray:
    """The statistic of each row of bytes under an encoding; rows have equal length."""
    n = windows.shape[1]
    share = SHARES[encoding]
    group = GROUP_OF[encoding][windows]
    cell = group + (np.arange(len(windows), dtype=np.int32) * len(share))[:, None]
    seen = np.bincount(cell.ravel(), minlength=len(windows) * len(share)).reshape(len(windows), len(share))
    chi = ((seen - n * share) ** 2 / (n * share)).sum(axis=1)
    free = max(1, len(share) - 1)
    # Cube root of chi-squared over its degrees of freedom is near normal.
    uniform = (np.cbrt(chi / free) - (1 - 2 / (9 * free))) / np.sqrt(2 / (9 * free))
    value = VALUES[encoding][windows]
    high = value >= np.float32(len(ENCODINGS[encoding][1]) / 2)
    above = high.sum(axis=1).astype(np.float64)
    below = n - above
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(axis=1)
    mean = 2 * above * below / n + 1
    spread = (mean - 1) * (mean - 2) / (n - 1)
    # A string on one side of the middle has no order to test; its groups are far from uniform.
    order = np.where(spread > 0, (runs - mean) / np.sqrt(np.maximum(spread, 1e-9)), np.sqrt(n))
    centred = value - value.mean(axis=1, keepdims=True)
    scale = np.einsum("ij,ij->i", centred, centred)
    lag = np.where(scale > 0, np.einsum("ij,ij->i", centred[:, 1:], centred[:, :-1]) / np.maximum(scale, 1e-9), 1.0)
    serial = (lag + 1 / n) * np.sqrt(n)
    return np.maximum(uniform, 0) ** 2 + order**2 + serial**2


def bin_of(statistic: np.ndarray) -> np.ndarray:
    return np.minimum((statistic / BIN).astype(np.int64), BINS - 1)


def class_of(length: int) -> int:
    return sum(length >= c for c in CLASSES) - 1


def _runs(inside: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Start and end of the runs of True of at least some length."""
    padded = np.zeros(len(inside) + 2, bool)
    padded[1:-1] = inside
    edges = np.flatnonzero(padded[1:] != padded[:-1])
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= least
    return list(zip(starts[long].tolist(), ends[long].tolist()))


_IS_HEX = np.zeros(256, bool)
_IS_HEX[[ord(c) for c in DIGITS + "abcdef"]] = True
_IS_WORD = HOLDS > 0


def base_spans(text: str, codes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the three patterns; codes are those of code_points()."""
    found = []
    if ":" in text or "=" in text:
        lower = text.lower()
        if any(word in lower for word in WORDS):
            found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(start, 2, end) for start, end in _runs(_IS_HEX[codes], HEX_LEAST)]
    return sorted(found)


def candidates(codes: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int, float]]:
    """(start, end, encoding, statistic) of long runs that meet no base span."""
    found = []
    for start, end in _runs(_IS_WORD[codes], SHORTEST):
        if any(start < e and s < end for s, _, e in base):
            continue
        window = codes[start:end][None, :]
        encoding = int(infer(window)[0])
        if encoding >= 0:
            found.append((start, end, encoding, float(battery(window, encoding)[0])))
    return found


def ordinary(codes: np.ndarray, base: list[tuple[int, int, int]]) -> np.ndarray:
    """The codes outside pattern matches and runs as long as a candidate."""
    inside = np.ones(len(codes), bool)
    for start, end in _runs(_IS_WORD[codes], SHORTEST):
        inside[start:end] = False
    for start, _, end in base:
        inside[start:end] = False
    return codes[inside]


class Windows:
    """Counts the windows of texts by class and bin; those of each class cover every letter.

    A text shorter than a class has no window of it. Windows of many texts wait for each other, so that the battery runs on large blocks.
    """

    def __init__(self):
        self.counts = np.zeros((len(CLASSES), BINS), np.int64)
        self.waiting: list[list[np.ndarray]] = [[] for _ in CLASSES]
        self.held = 0

    def add(self, codes: np.ndarray) -> None:
        letters = codes[_IS_WORD[codes]]
        for at, length in enumerate(CLASSES):
            whole = len(letters) // length * length
            if whole:
                self.waiting[at].append(letters[:whole].reshape(-1, length))
                if whole < len(letters):  # the rest, in a window that ends with the text
                    self.waiting[at].append(letters[None, -length:])
        self.held += len(letters)
        if self.held > 1 << 19:
            self.flush()

    def flush(self) -> None:
        for at, blocks in enumerate(self.waiting):
            windows = np.concatenate(blocks) if blocks else np.zeros((0, CLASSES[at]), np.uint8)
            encodings = infer(windows)
            for encoding in np.unique(encodings[encodings >= 0]):
                self.counts[at] += np.bincount(bin_of(battery(windows[encodings == encoding], encoding)), minlength=BINS)
            blocks.clear()
        self.held = 0


ROW = (
    "doc_id BIGINT, base ARRAY<STRUCT<start: INT, kind: INT, end: INT>>, "
    "found ARRAY<STRUCT<start: INT, end: INT, encoding: INT, statistic: DOUBLE>>, counts ARRAY<BIGINT>"
)
_BASE = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
_FOUND = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("encoding", pa.int32()), ("statistic", pa.float64())]))


def code_points(text: str) -> np.ndarray:
    """A byte per code point; those beyond Latin-1 become a question mark, which is in no alphabet."""
    return np.frombuffer(text.encode("latin-1", "replace"), np.uint8)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and last a row with the task's counts of ordinary windows."""
    windows = Windows()

    def rows(ids, base, found, tallies):
        columns = [pa.array(ids, pa.int64()), pa.array(base, _BASE), pa.array(found, _FOUND), pa.array(tallies, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "base", "found", "counts"])

    for batch in batches:
        base, found = [], []
        for text in batch.column(1):
            text = text.as_py() or ""
            codes = code_points(text)
            spans = base_spans(text, codes)
            base.append([dict(zip(("start", "kind", "end"), s)) for s in spans])
            found.append([dict(zip(("start", "end", "encoding", "statistic"), c)) for c in candidates(codes, spans)])
            windows.add(ordinary(codes, spans))
        yield rows(batch.column(0).to_pylist(), base, found, [None] * len(base))
    windows.flush()
    if windows.counts.any():
        yield rows([None], [None], [None], [windows.counts.ravel().tolist()])


def discoveries(ordinary: np.ndarray, tested: np.ndarray, rate: float = RATE) -> list[int]:
    """Largest bin taken by class (-1 for none), from counts by class and bin.

    The p-value of a cell is the share of ordinary windows in its bin or lower ones,
    counted one higher, so that it is never zero.
    """
    total = ordinary.sum(axis=1, keepdims=True)
    p = (1 + ordinary.cumsum(axis=1)) / (1 + total)
    cells = sorted((p[c, b], c, b) for c, b in zip(*np.nonzero(tested)))
    m, taken, limit = tested.sum(), 0, -1.0
    for value, c, b in cells:
        taken += tested[c, b]
        if value <= rate * taken / m:
            limit = value
    return [max((b for b in range(BINS) if p[c, b] <= limit), default=-1) for c in range(len(CLASSES))]


def _table(rows: DataFrame) -> np.ndarray:
    """Counts by class and bin from rows (cell, n): as many rows at most as there are cells."""
    out = np.zeros(len(CLASSES) * BINS, np.int64)
    for cell, n in rows.groupBy("cell").agg(F.sum("n")).collect():
        out[cell] = n
    return out.reshape(len(CLASSES), BINS)


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rate: float = RATE) -> DataFrame:
    """doc_id, base and added spans of every row.

    base: array of (start, kind, end), kind as an index of KINDS; added: array of
    (start, end, encoding, statistic, p bin) of the discoveries, in order.
    """
    ready(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scanned = written(narrow.mapInArrow(_scan, ROW), "secrets")
    ordinary = _table(scanned.where("counts IS NOT NULL").select(F.posexplode("counts").alias("cell", "n")))
    rows = scanned.where("counts IS NULL").select("doc_id", "base", "found")
    length = F.col("c.end") - F.col("c.start")
    kind = sum((F.when(length >= c, 1).otherwise(0) for c in CLASSES[1:]), F.lit(0))
    place = F.least(F.floor(F.col("c.statistic") / BIN), F.lit(BINS - 1))
    tested = _table(rows.select(F.explode("found").alias("c")).select((kind * BINS + place).cast("int").alias("cell"), F.lit(1).alias("n")))
    limits = discoveries(ordinary, tested, rate)

    def taken(c: Column) -> Column:
        long = c["end"] - c["start"]
        limit = F.lit(limits[0])
        for least, bound in zip(CLASSES[1:], limits[1:]):
            limit = F.when(long >= least, F.lit(bound)).otherwise(limit)
        return (F.floor(c["statistic"] / BIN) <= limit) & (c["statistic"] <= NOT_RANDOM)

    return rows.select("doc_id", "base", F.filter("found", taken).alias("added"))


def spans_text(spans: Column, names: tuple[str, ...]) -> Column:
    """Array of (start, kind, end) as kind:start:end by start, then kind."""
    kinds = F.array(*[F.lit(n) for n in names])
    show = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), show), ",")


def digests(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    extra = F.transform("added", lambda s: F.struct(s["start"].alias("start"), F.lit(len(KINDS)).alias("kind"), s["end"].alias("end")))
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(spans_text(F.col("base"), KINDS), 256).alias("base_sha256"),
        spans_text(F.concat("base", extra), (*KINDS, "random")).alias("spans"),
    )
