"""Address ranges from binary search-tree files.

Such a file has a tree over the bits of an address, with records of 24, 28 or 32 bits, a
section of typed data that leaves point to, and its own description at the end. The file
is one unit that is read whole and has a stated limit; its bytes go to every executor once,
and each task walks one subtree.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from scanlake.session import ship_package

#: A larger file is refused: its bytes are held by every executor.
FILE_BYTES = 512 << 20
#: Tasks walk the subtrees below the first bits of an address.
SUBTREE_BITS = 8

# Fixed values of the format.
MARKER = b"\xab\xcd\xefMaxMind.com"
SEPARATOR = 16
POINTER, TEXT, DOUBLE, BYTES, UINT16, UINT32, MAP, INT32, UINT64, UINT128, ARRAY, _, _, BOOLEAN, FLOAT = range(1, 16)

FIELDS = {
    "asn": ("autonomous_system_number",),
    "as_name": ("autonomous_system_organization",),
    "org": ("organization",),
    "country": ("country", "iso_code"),
}
SCHEMA = "start_ip BIGINT, end_ip BIGINT, netblock STRING, asn BIGINT, as_name STRING, org STRING, country STRING"
_TYPES = [("start_ip", pa.int64()), ("end_ip", pa.int64()), ("netblock", pa.string()), ("asn", pa.int64()), ("as_name", pa.string()), ("org", pa.string()), ("country", pa.string())]


class MalformedFile(ValueError):
    """Bytes that are no search-tree file."""


class TreeFile:
    """The bytes of a file, read where they are asked for."""

    def __init__(self, data: bytes):
        self.data = data
        at = data.rfind(MARKER)
        if at < 0:
            raise MalformedFile("no description at the end of the file")
        about, _ = self.value(at + len(MARKER), at + len(MARKER))
        self.nodes, self.bits, self.version = about["node_count"], about["record_size"], about["ip_version"]
        if self.bits not in (24, 28, 32):
            raise MalformedFile(f"records of {self.bits} bits")
        self.section = self.nodes * self.bits // 4 + SEPARATOR
        self.found: dict[int, dict] = {}

    def child(self, node: int, bit: int) -> int:
        if self.bits == 28:
            # Seven bytes a node; the middle one has the high four bits of both records.
            seven = self.data[node * 7 : node * 7 + 7]
            high = seven[3] >> 4 if bit == 0 else seven[3] & 15
            return high << 24 | int.from_bytes(seven[4 * bit : 4 * bit + 3], "big")
        size = self.bits // 8
        at = (2 * node + bit) * size
        return int.from_bytes(self.data[at : at + size], "big")

    def root(self) -> int:
        """Where the addresses of 32 bits begin: below 96 zeros if the tree has 128."""
        node = 0
        for _ in range(96 if self.version == 6 else 0):
            if node >= self.nodes:
                break
            node = self.child(node, 0)
        return node

    def record(self, node: int) -> dict:
        """The wanted fields of the data a leaf points to."""
        if node not in self.found:
            value, _ = self.value(node - self.nodes - SEPARATOR + self.section, self.section)
            out = {}
            for name, path in FIELDS.items():
                part = value
                for key in path:
                    part = part.get(key) if isinstance(part, dict) else None
                out[name] = part
            self.found[node] = out
        return self.found[node]

    def value(self, at: int, base: int):
        """The typed value at a place, and the place after it; pointers count from ``base``."""
        control = self.data[at]
        kind, at = control >> 5, at + 1
        if kind == POINTER:
            size = (control >> 3) & 3
            if size == 3:
                low, high, more = int.from_bytes(self.data[at : at + 4], "big"), 0, 0
            else:
                low = int.from_bytes(self.data[at : at + size + 1], "big")
                high, more = (control & 7) << 8 * (size + 1), (0, 2048, 526336)[size]
            return self.value(base + high + low + more, base)[0], at + size + 1
        if kind == 0:
            kind, at = self.data[at] + 7, at + 1
        size = control & 31
        if size >= 29:
            more = size - 28
            size = (29, 285, 65821)[more - 1] + int.from_bytes(self.data[at : at + more], "big")
            at += more
        if kind == MAP:
            out = {}
            for _ in range(size):
                key, at = self.value(at, base)
                out[key], at = self.value(at, base)
            return out, at
        if kind == ARRAY:
            items = []
            for _ in range(size):
                item, at = self.value(at, base)
                items.append(item)
            return items, at
        if kind == BOOLEAN:
            return bool(size), at
        raw, at = self.data[at : at + size], at + size
        if kind == TEXT:
            return raw.decode(), at
        if kind == BYTES:
            return raw, at
        if kind in (DOUBLE, FLOAT):
            return struct.unpack(">d" if kind == DOUBLE else ">f", raw)[0], at
        if kind == INT32:
            return int.from_bytes(raw.rjust(4, b"\0"), "big", signed=True), at
        if kind in (UINT16, UINT32, UINT64, UINT128):
            return int.from_bytes(raw, "big"), at
        raise MalformedFile(f"data of type {kind}")

    def subtree(self, number: int, bits: int) -> Iterator[tuple[int, int, dict]]:
        """(first address, prefix length, record) of the leaves below the given first bits."""
        node, depth = self.root(), 0
        while depth < bits and node < self.nodes:
            node = self.child(node, number >> (bits - 1 - depth) & 1)
            depth += 1
        if depth < bits and number & ((1 << (bits - depth)) - 1):
            return  # a leaf above: the first of the subtrees below it tells it
        todo = [(node, number << (32 - bits), depth)]
        while todo:
            node, first, depth = todo.pop()
            if node < self.nodes:
                if depth >= 32:
                    raise MalformedFile("the tree is deeper than an address")
                todo += [(self.child(node, 1), first | 1 << (31 - depth), depth + 1), (self.child(node, 0), first, depth + 1)]
            elif node > self.nodes:
                yield first, depth, self.record(node)


def _text(number: int) -> str:
    return ".".join(str(number >> shift & 255) for shift in (24, 16, 8, 0))


def ranges_of_file(content: DataFrame, bits: int = SUBTREE_BITS) -> DataFrame:
    """Ranges of IPv4 addresses in a file, given as the one row ``content`` (bytes).

    ``start_ip``, ``end_ip`` (numbers, disjoint: a leaf each), ``netblock``, ``asn``,
    ``as_name``, ``org``, ``country``; what a record does not have is null. No row gives no
    range; a file of over ``FILE_BYTES`` is an error.
    """
    spark: SparkSession = content.sparkSession
    ship_package(spark)
    sized = content.selectExpr("length(content) AS n").first()
    if sized is None:
        return spark.createDataFrame([], SCHEMA)
    if sized.n > FILE_BYTES:
        raise ValueError(f"a file of {sized.n} bytes; the limit is {FILE_BYTES}")
    data = spark.sparkContext.broadcast(content.select("content").first().content)
    TreeFile(data.value)  # a malformed file is an error here

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file = TreeFile(data.value)
        for batch in batches:
            for number in batch.column(0).to_pylist():
                rows = []
                for first, length, record in file.subtree(number, bits):
                    rows.append({"start_ip": first, "end_ip": first + (1 << (32 - length)) - 1, "netblock": f"{_text(first)}/{length}", **record})
                    if len(rows) == 10_000:
                        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(_TYPES))
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema(_TYPES))

    subtrees = 1 << bits
    return spark.range(0, subtrees, 1, min(subtrees, 4 * spark.sparkContext.defaultParallelism)).mapInArrow(walk, SCHEMA)


def read_range_file(spark: SparkSession, path: str) -> DataFrame:
    return ranges_of_file(spark.read.format("binaryFile").load(path).select("content"))
