"""Byte-level BPE by longest matches and backtracking.

The bytes of a piece are mapped to Latin-1 characters, one each, so that an Aho-Corasick
automaton over strings finds every token at every place in one pass. Encoding walks the
piece with the longest token first. A token may follow another only if merging their
bytes by rank would leave the border between them; that is memoised by pair. A place
from which no token leads on is never tried again, because the tokens before a place are
determined by it: linear time, and the same ids as merging by rank. Shorter tokens at a
place are the prefixes of the longest one, which are linked once for the vocabulary.

The ids of pieces are memoised in two generations, so that frequent ones outlive the
bound. Texts within Latin-1 are cut by the same pattern written with plain character
sets, which is compiled to a faster matcher.

Needs a vocabulary in which every token's own bytes encode to that token and every single
byte is a token; ``Vocabulary`` checks the second and ``split`` the first.

Defined cases: null and empty texts give no tokens and empty bytes; texts of any length
are encoded whole; decoding gives back the exact UTF-8 bytes.
"""

from __future__ import annotations

import base64
import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.llm.common import ready

#: Entries of a generation of memoised pieces, and of the memo of pairs before it is emptied.
PIECES = 120_000
PAIRS = 1_000_000
#: Longest piece that is memoised.
MEMO_CHARS = 64
NEVER = 1 << 62


def latin_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts within Latin-1, its Unicode classes written out; None if it has other ones."""
    members = lambda of: "".join(re.escape(chr(c)) for c in range(256) if regex.fullmatch(of, chr(c)))
    out, inside, at = "", False, 0
    while at < len(pattern):
        found = regex.compile(r"\\p\{\w+\}|\\[sS]|\\.|.", regex.DOTALL).match(pattern, at)[0]
        at += len(found)
        if found in "[]":
            inside = found == "["
        if found[:2] in (r"\p", r"\s"):
            out += members(found) if inside else f"[{members(found)}]"
        elif found == r"\S" and not inside:
            out += f"[^{members(chr(92) + 's')}]"
        elif found[0] == "\\" and found[1].isalpha():
            return None
        else:
            out += found
    return re.compile(out)


class Vocabulary:
    """Tokens by rank, their automaton, and the memos of pieces and pairs."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        self.wide, self.latin = regex.compile(pattern), latin_pattern(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.size, self.shorter = [0] * (max(self.tokens) + 1), [-1] * (max(self.tokens) + 1)
        for token, rank in ranks.items():
            self.size[rank] = len(token)
            # The longest token that begins a token; -1 for single bytes.
            self.shorter[rank] = next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in ranks), -1)
        # The bytes of all tokens one after the other, for decoding.
        self.flat = np.frombuffer(b"".join(self.tokens.get(rank, b"") for rank in range(len(self.size))), np.uint8)
        self.sizes = np.array(self.size, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.right: dict[int, list[int]] = {}
        self.left: dict[int, list[int]] = {}

    def split(self, rank: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes a token; None for a single byte."""
        parts = [self.ranks[bytes([b])] for b in self.tokens[rank]]
        if len(parts) == 1:
            return None
        while len(parts) > 2:
            merged = [self.ranks.get(self.tokens[a] + self.tokens[b], NEVER) for a, b in zip(parts, parts[1:])]
            at = merged.index(min(merged))
            if merged[at] == NEVER:
                raise ValueError(f"token {rank} is not reached by merges")
            parts[at : at + 2] = [merged[at]]
        return parts[0], parts[1]

    def spine(self, rank: int, side: int) -> list[int]:
        """The tokens at one edge of a token while it is built, from the byte to itself."""
        known = self.right if side else self.left
        if rank not in known:
            parts = self.split(rank)
            known[rank] = [*(self.spine(parts[side], side) if parts else []), rank]
        return known[rank]

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging by rank never joins the last part of a with the first of b."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._compatible(self.spine(a, 1), self.spine(b, 0))
        return known

    def _compatible(self, ends: list[int], starts: list[int]) -> bool:
        i = j = 0
        while True:
            across = self.ranks.get(self.tokens[ends[i]] + self.tokens[starts[j]], NEVER)
            next_a = ends[i + 1] if i + 1 < len(ends) else NEVER
            next_b = starts[j + 1] if j + 1 < len(starts) else NEVER
            # The lowest rank merges first; of equal ones the leftmost.
            if across < next_a and across <= next_b:
                return False
            if next_a == next_b == NEVER:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        size, shorter, pairs = self.size, self.shorter, self.pairs
        longest = [0] * len(piece)
        for end, rank in self.automaton.iter(piece.decode("latin-1")):  # by end, so the longest comes last
            longest[end + 1 - size[rank]] = rank
        out: list[int] = []
        at, dead, rank = 0, bytearray(len(piece) + 1), longest[0]
        while True:
            end = at + size[rank]
            if not dead[end]:
                fits = not out or pairs.get((out[-1], rank))
                if fits is None:
                    fits = self.compatible(out[-1], rank)
                if fits:
                    out.append(rank)
                    if end == len(piece):
                        return out
                    at, rank = end, longest[end]
                    continue
            rank = shorter[rank]
            while rank < 0:  # nothing leads on from here
                dead[at] = 1
                last = out.pop()
                at -= size[last]
                rank = shorter[last]

    def pieces_of(self, text: str) -> list[str]:
        if self.latin is not None:
            try:
                text.encode("latin-1")
                return self.latin.findall(text)
            except UnicodeEncodeError:
                pass
        return self.wide.findall(text)

    def piece_ids(self, piece: str) -> bytes:
        """Ids of a piece that is not among the young ones."""
        ids = self.old.get(piece)
        if ids is None:
            ids = np.array(self.encode_piece(piece.encode()), "<i4").tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self.young) >= PIECES:
                self.old, self.young = self.young, {}
            self.young[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit little-endian numbers."""
        pieces = self.pieces_of(text)
        found = list(map(self.young.get, pieces))
        if None in found:
            found = [self.piece_ids(piece) if ids is None else ids for ids, piece in zip(found, pieces)]
        return b"".join(found)

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ids, as an array."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        return self.flat[shift + np.arange(len(shift))]


_vocabularies: dict[str, Vocabulary] = {}


def read_vocabulary(data: bytes, pattern: str) -> Vocabulary:
    """A rank file's vocabulary; built once in a worker."""
    key = hashlib.sha256(data + pattern.encode()).hexdigest()
    if key not in _vocabularies:
        pairs = (line.split() for line in data.splitlines() if line.strip())
        _vocabularies[key] = Vocabulary({base64.b64decode(token): int(rank) for token, rank in pairs}, pattern)
    return _vocabularies[key]


class Codec:
    """Columns that encode texts and decode ids by one rank file.

    The file is read by the driver and broadcast: a vocabulary, about a megabyte,
    whatever the input.
    """

    def __init__(self, spark: SparkSession, path: str, pattern: str):
        ready(spark)
        with open(path, "rb") as file:
            ranks = spark.sparkContext.broadcast(file.read())

        def ids_of(texts: pa.Array) -> pa.Array:
            vocabulary = read_vocabulary(ranks.value, pattern)
            found = [vocabulary.encode(text.as_py() or "") for text in texts]
            offsets = np.concatenate([[0], np.cumsum([len(ids) // 4 for ids in found])]).astype(np.int32)
            return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))

        def bytes_of(ids: pa.Array) -> pa.Array:
            decode = read_vocabulary(ranks.value, pattern).decode
            return pa.array([decode(some.values.to_numpy()).tobytes() if some.is_valid else b"" for some in ids], pa.binary())

        @F.arrow_udf("array<int>")
        def encode(texts: pa.Array) -> pa.Array:
            return ids_of(texts)

        @F.arrow_udf("binary")
        def decode(ids: pa.Array) -> pa.Array:
            return bytes_of(ids)

        # One function, as two in a row over the same text would encode it twice.
        @F.arrow_udf("struct<ids: array<int>, decoded: binary>")
        def round_trip(texts: pa.Array) -> pa.Array:
            ids = ids_of(texts)
            return pa.StructArray.from_arrays([ids, bytes_of(ids)], names=["ids", "decoded"])

        self._encode, self._decode, self._round_trip = encode, decode, round_trip

    def encode(self, text: Column) -> Column:
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        return self._decode(ids)

    def round_trip(self, text: Column) -> Column:
        """A struct of the ids and the bytes that they decode to."""
        return self._round_trip(text)


def encoded(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids and decoded (the bytes that the ids give back) of every row."""
    codec = Codec(docs.sparkSession, path, pattern)
    rows = docs.select(F.col(doc_id).alias("doc_id"), codec.round_trip(F.col(text).cast("string")).alias("both"))
    return rows.select("doc_id", "both.ids", "both.decoded")


def digests(rows: DataFrame) -> DataFrame:
    """The columns of rows with n_tokens, ids_sha256 and decoded_sha256 for ids and decoded."""
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return rows.withColumns(
        {
            "n_tokens": F.size("ids").cast("bigint"),
            "ids_sha256": F.sha2(joined, 256),
            "decoded_sha256": F.sha2(F.col("decoded"), 256),
        }
    )
