"""Personal data: four fixed patterns, and spans of a character BiLSTM-CRF.

The network reads windows of ``WINDOW`` characters, every ``STRIDE`` characters, over all
places within ``REACH`` characters of a digit or an ``@`` (no kind it learns is without
one; a text full of digits is read whole). Where windows overlap, their tag scores are
blended by how central the place is in each, and one Viterbi path over the whole stretch,
however long, settles the tags: windows are reconciled globally, not cut at borders.

It is trained on the driver, in numpy, on labelled spans: samples of each kind in many
spellings (with look-alikes as negatives) set into stretches of at most ``SAMPLE``
documents, the smallest hashed id of each of as many buckets; pattern matches in these stretches are
labelled too. The model is a few thousand numbers and travels in the task.

Defined cases: a null text is empty; offsets are code points; a network span that meets
a pattern match is dropped, pattern matches stay; rows are treated one by one; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanlake.llm import lstm_crf
from scanlake.llm.common import ready
from scanlake.llm.secrets_scan import spans_text

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A run of digits that fails from its first digit fails from all others.
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")

WINDOW, STRIDE, REACH = 64, 32, 24
HIDDEN, EPOCHS, SEED = 16, 7, 5
#: Documents whose stretches serve as context in training, and windows trained on.
SAMPLE, TRAINED = 300, 2600
#: Padded places that stretches are tagged in at once, and the length from which a stretch is tagged alone.
CELLS, LONG = 1 << 18, 1 << 15
TAGS = 1 + 2 * len(KINDS)  # outside; first and further characters of each kind
IMPOSSIBLE = -1e4


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches."""
    found = []
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, 0, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    if DIGIT.search(text):
        for m in IP.finditer(text):
            # Leading zeros do not make a part larger; a long part is never turned into a number.
            if all(len(part.lstrip("0")) < 4 and int(part[-3:]) <= 255 for part in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 10 <= len(DIGIT.findall(m[0])) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _symbols() -> np.ndarray:
    """Symbol of each Latin-1 code: printable ASCII by itself, then space-like, other letters, others."""
    table = np.full(256, 98, np.int64)
    table[32:127] = np.arange(1, 96)
    table[[9, 10, 11, 12, 13]] = 96
    table[192:] = 97
    return table


SYMBOL, SYMBOLS = _symbols(), 99  # 0 stands outside the text
_TRIGGER = np.zeros(256, bool)
_TRIGGER[[ord(c) for c in "0123456789@"]] = True


def stretches(codes: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of the places within REACH of a digit or @."""
    at = np.flatnonzero(_TRIGGER[codes])
    if not len(at):
        return []
    gaps = np.flatnonzero(np.diff(at) > 2 * REACH)
    starts, ends = at[np.concatenate([[0], gaps + 1])], at[np.concatenate([gaps, [len(at) - 1]])]
    return [(max(0, int(s) - REACH), min(len(codes), int(e) + 1 + REACH)) for s, e in zip(starts, ends)]


def allowed_moves(moves: np.ndarray) -> np.ndarray:
    """Transitions with those into a further character ruled out, except from its own kind."""
    out = moves.copy()
    for kind in range(len(KINDS)):
        first, further = 1 + 2 * kind, 2 + 2 * kind
        for tag in range(TAGS):
            if tag not in (first, further):
                out[tag, further] = IMPOSSIBLE
    return out


_CENTRAL = np.minimum(np.arange(WINDOW) + 1, WINDOW - np.arange(WINDOW)).astype(np.float32)


def window_starts(length: int) -> list[int]:
    return list(range(0, max(1, length - WINDOW + STRIDE), STRIDE))


def blended_blocks(model: dict[str, np.ndarray], piece: np.ndarray) -> Iterator[np.ndarray]:
    """Blended scores of a long piece in order, some thousand places at a time."""
    at, many = window_starts(len(piece)), 1024
    over = np.zeros((WINDOW, TAGS), np.float32), np.zeros((WINDOW, 1), np.float32)  # what earlier windows left
    for i in range(0, len(at), many):
        part = at[i : i + many]
        windows = np.zeros((len(part), WINDOW), np.int64)
        for row, s in enumerate(part):
            shown = piece[s : s + WINDOW]
            windows[row, : len(shown)] = shown
        emitted = lstm_crf.scores(model, windows)
        size = part[-1] - part[0] + WINDOW
        total, weight = np.zeros((size, TAGS), np.float32), np.zeros((size, 1), np.float32)
        total[: WINDOW - STRIDE], weight[: WINDOW - STRIDE] = over[0][: WINDOW - STRIDE], over[1][: WINDOW - STRIDE]
        for row, s in enumerate(part):
            total[s - part[0] : s - part[0] + WINDOW] += emitted[row] * _CENTRAL[:, None]
            weight[s - part[0] : s - part[0] + WINDOW] += _CENTRAL[:, None]
        ready_to = len(part) * STRIDE if i + many < len(at) else len(piece) - part[0]
        yield total[:ready_to] / weight[:ready_to]
        over = total[ready_to:], weight[ready_to:]


def tag_stretches(model: dict[str, np.ndarray], pieces: list[np.ndarray]) -> list[np.ndarray]:
    """Tags of each piece (symbols of a stretch): blended window scores, one path per piece.

    Pieces of like length go together, as many as have CELLS places when padded; a long
    piece goes alone and in blocks. So memory does not grow with what else is there.
    """
    moves = allowed_moves(model["moves"])
    tags: list[np.ndarray] = [np.zeros(0, np.int8)] * len(pieces)
    order = sorted(range(len(pieces)), key=lambda i: len(pieces[i]))
    while order and len(pieces[order[-1]]) > LONG:
        which = order.pop()
        tags[which] = lstm_crf.viterbi_blocks(_opened(blended_blocks(model, pieces[which])), moves)
    while order:
        many = max(1, CELLS // max(1, len(pieces[order[-1]])))
        order, group = order[:-many], order[-many:]
        for which, path in zip(group, _paths(model, [pieces[i] for i in group], moves)):
            tags[which] = path
    return tags


def _opened(blocks: Iterator[np.ndarray]) -> Iterator[np.ndarray]:
    for i, block in enumerate(blocks):
        if i == 0:
            block[0, 2::2] += IMPOSSIBLE  # nothing begins with a further character
        yield block


def _paths(model: dict[str, np.ndarray], pieces: list[np.ndarray], moves: np.ndarray) -> list[np.ndarray]:
    """Tags of pieces that are padded to the longest one."""
    starts = [window_starts(len(p)) for p in pieces]
    windows = np.zeros((sum(map(len, starts)), WINDOW), np.int64)
    row = 0
    for piece, at in zip(pieces, starts):
        for s in at:
            part = piece[s : s + WINDOW]
            windows[row, : len(part)] = part
            row += 1
    emitted = np.concatenate([lstm_crf.scores(model, windows[i : i + 1024]) for i in range(0, len(windows), 1024)])
    padded = np.zeros((len(pieces), max(map(len, pieces)), TAGS), np.float32)
    padded[:, :, 1:] = IMPOSSIBLE  # behind its end a piece is outside
    row = 0
    for i, (piece, at) in enumerate(zip(pieces, starts)):
        size = at[-1] + WINDOW
        total, weight = np.zeros((size, TAGS), np.float32), np.zeros((size, 1), np.float32)
        for s in at:
            total[s : s + WINDOW] += emitted[row] * _CENTRAL[:, None]
            weight[s : s + WINDOW] += _CENTRAL[:, None]
            row += 1
        padded[i, : len(piece)] = (total / weight)[: len(piece)]
    padded[:, 0, 2::2] += IMPOSSIBLE  # nothing begins with a further character
    return [path[: len(piece)] for piece, path in zip(pieces, lstm_crf.viterbi(padded, moves))]


def tagged_spans(tags: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the tagged stretches."""
    found, start, kind = [], None, 0
    for i, tag in enumerate([*tags.tolist(), 0]):
        if start is not None and tag != 2 + 2 * kind:
            found.append((start, kind, i))
            start = None
        if tag % 2:
            start, kind = i, (tag - 1) // 2
    return found


def plausible(kind: int, shown: str) -> bool:
    """What a span needs at least to be of its kind."""
    digits = len(DIGIT.findall(shown))
    least = (0, 4, 12, 9)[kind]
    return digits >= least and (kind != 0 or ("@" in shown and "." in shown)) and (kind != 1 or shown.count(".") == 3)


def whole_run(text: str, start: int, end: int) -> tuple[int, int] | None:
    """A span moved to the borders of the digits it cuts; None if it then cuts a word."""
    while start > 0 and text[start].isdigit() and text[start - 1] in "0123456789":
        start -= 1
    while end < len(text) and text[end - 1].isdigit() and text[end] in "0123456789":
        end += 1
    inside = (start > 0 and text[start].isalnum() and text[start - 1].isalnum()) or (
        end < len(text) and text[end - 1].isalnum() and text[end].isalnum()
    )
    return None if inside else (start, end)


def network_spans(model: dict[str, np.ndarray], texts: list[str], known: list[list[tuple[int, int, int]]]) -> list[list[tuple[int, int, int]]]:
    """Spans that the network adds to each text."""
    places, pieces = [], []
    for i, text in enumerate(texts):
        codes = np.frombuffer(text.encode("latin-1", "replace"), np.uint8)
        for start, end in stretches(codes):
            places.append((i, start))
            pieces.append(SYMBOL[codes[start:end]])
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if pieces:
        covered: dict[int, bytearray] = {}  # places of known and added spans, of one text at a time
        for (i, offset), tags in zip(places, tag_stretches(model, pieces)):
            if i not in covered:
                covered = {i: bytearray(len(texts[i]))}
                for s, _, e in known[i]:
                    covered[i][s:e] = b"\1" * (e - s)
            for start, kind, end in tagged_spans(tags):
                run = whole_run(texts[i], start + offset, end + offset)
                if run and plausible(kind, texts[i][slice(*run)]) and not any(covered[i][slice(*run)]):
                    added[i].append((run[0], kind, run[1]))
                    covered[i][slice(*run)] = b"\1" * (run[1] - run[0])
    return added


def _numbers(rng: random.Random, n: int) -> str:
    return "".join(rng.choices("0123456789", k=n))


def sample_span(rng: random.Random) -> tuple[int, str]:
    """A kind (-1 for a look-alike of none) and a spelling."""
    number = lambda n: _numbers(rng, n)
    word = lambda: "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(2, 9)))
    kind = rng.randrange(-1, len(KINDS))
    if kind == 0:
        name = rng.choice([word(), f"{word()}.{word()}", f"{word()}{number(2)}", f"{word()}.{number(2)}", f"{word()}_{word()}", word().title()])
        host = rng.choice([f"{word()}.{word()[:3]}", f"mail{number(1)}.{word()}.com", f"{word()}-{word()}.co.uk", f"{word()}.{word()}.org"])
        return kind, rng.choice(["{}@{}", "{}@{}", "{}@{}", "{} @ {}"]).format(name, host)
    if kind == 1:
        return kind, ".".join(str(rng.randrange(256)) for _ in range(4))
    if kind == 2:
        digits = number(rng.choice([14, 15, 16, 16, 16, 16, 19]))
        joint = rng.choice(["", "", " ", "-"])
        return kind, joint.join(digits[i : i + 4] for i in range(0, len(digits), 4))
    if kind == 3:
        code, a, b, c = rng.choice(["1", "44", "49", "33", "351"]), number(3), number(3), number(4)
        forms = ["+{0} ({1}) {2}-{3}", "+{0} {1} {2} {3}", "+{0}-{1}-{2}-{3}", "+{0}{1}{2}{3}", "({1}) {2}-{3}", "{1}-{2}-{3}", "00{0} {1} {2}{3}", "+{0} ({1}) {2}.{3}"]
        return kind, rng.choice(forms).format(code, a, b, c)
    odd = [number(rng.randrange(1, 9)), f"{number(1)}.{number(1)}.{number(2)}", f"{number(4)}-{number(2)}-{number(2)}", f"{number(2)}:{number(2)}", f"${number(3)}.{number(2)}", f"{number(3)},{number(3)}", f"@{word()}", f"v{number(1)}.{number(1)}", "".join(rng.choices("0123456789abcdef", k=rng.randrange(8, 41))), f"{number(2)}%", f"#{number(4)}", f"{word()}{number(2)}"]
    return -1, rng.choice(odd)


def training_windows(contexts: list[str], count: int = TRAINED, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of windows with labelled spans."""
    rng = random.Random(seed)
    ids, tags = np.zeros((count, WINDOW), np.int64), np.zeros((count, WINDOW), np.int64)
    contexts = [c for c in contexts if c] or ["the quick brown fox and the other"]
    for row in range(count):
        context = rng.choice(contexts)
        at = rng.randrange(len(context))
        text, spans = context[at : at + rng.randrange(5, 60)], []
        for _ in range(rng.choice([1, 1, 2])):
            kind, shown = sample_span(rng)
            lead = rng.choice([" ", " ", " ", ": ", "\n", "(", ", "])
            if kind >= 0:
                spans.append((len(text) + len(lead), kind, len(text) + len(lead) + len(shown)))
            after = rng.randrange(len(context))
            text += lead + shown + rng.choice([" ", " ", " ", ", ", ". ", "\n", ")", "###", "!! "]) + context[after : after + rng.randrange(0, 40)]
        spans += [s for s in base_spans(text) if not any(s[0] < e and b < s[2] for b, _, e in spans)]
        marks = np.zeros(len(text), np.int64)
        for start, kind, end in spans:
            marks[start:end] = 2 + 2 * kind
            marks[start] = 1 + 2 * kind
        first = rng.randrange(max(1, len(text) - WINDOW + 1))
        part = np.frombuffer(text[first : first + WINDOW].encode("latin-1", "replace"), np.uint8)
        ids[row, : len(part)] = SYMBOL[part]
        tags[row, : len(part)] = marks[first : first + WINDOW]
    return ids, tags


def contexts_of(docs: DataFrame, doc_id: str, text: str, most: int = SAMPLE) -> list[str]:
    """Stretches of at most ``most`` documents, from anywhere in their texts."""
    hashed = F.xxhash64(F.col(doc_id).cast("string"))
    length = F.greatest(F.length(text) - 400, F.lit(0))
    start = F.pmod(F.xxhash64(F.col(doc_id).cast("string"), F.lit(1)), length + 1).cast("int") + 1
    piece = F.substr(F.col(text), start, F.lit(400))
    rows = docs.where(F.length(text) > 0).select(F.pmod(hashed, F.lit(most)).alias("bucket"), F.struct(hashed.alias("h"), piece.alias("piece")).alias("one"))
    # The smallest hash of each of so many buckets: tasks send partial minima, the driver gets one row a bucket.
    return [r["piece"] for r in rows.groupBy("bucket").agg(F.min("one").alias("one")).select("bucket", "one.piece").orderBy("bucket").collect()]


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", most: int = SAMPLE) -> dict[str, np.ndarray]:
    ids, tags = training_windows(contexts_of(docs.select(F.col(doc_id), F.col(text).cast("string")), doc_id, text, most))
    return lstm_crf.train(ids, tags, SYMBOLS, HIDDEN, TAGS, EPOCHS, SEED)


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
ROW = "doc_id BIGINT, base ARRAY<STRUCT<start: INT, kind: INT, end: INT>>, added ARRAY<STRUCT<start: INT, kind: INT, end: INT>>"


class Scan:
    def __init__(self, model: dict[str, np.ndarray]):
        self.model = model

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        show = lambda spans: [dict(zip(("start", "kind", "end"), s)) for s in spans]
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                texts = [t.as_py() or "" for t in part.column(1)]
                base = [base_spans(text) for text in texts]
                added = network_spans(self.model, texts, base)
                columns = [part.column(0), pa.array(map(show, base), _SPANS), pa.array(map(show, added), _SPANS)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "base", "added"])


def personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: dict[str, np.ndarray] | None = None) -> DataFrame:
    """doc_id, base and added spans (start, kind, end) of every row; kind is an index of KINDS."""
    ready(docs.sparkSession)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(Scan(model or fit(docs, doc_id, text)), ROW)


def digests(found: DataFrame) -> DataFrame:
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(spans_text(F.col("base"), KINDS), 256).alias("base_sha256"),
        spans_text(F.concat("base", "added"), KINDS).alias("spans"),
    )
