"""Files and certificates in their binary forms, written from rows of the given tables."""

from __future__ import annotations

import base64
from collections.abc import Iterable

# Fixed values of the two formats.
MARKER = b"\xab\xcd\xefMaxMind.com"
COMMON_NAME, ALTERNATIVE_NAMES = b"\x06\x03\x55\x04\x03", b"\x06\x03\x55\x1d\x11"
ALGORITHM = b"\x30\x0d\x06\x09\x2a\x86\x48\x86\xf7\x0d\x01\x01\x0b\x05\x00"


def der(tag: int, *inside: bytes) -> bytes:
    data = b"".join(inside)
    if len(data) < 128:
        return bytes([tag, len(data)]) + data
    size = len(data).to_bytes((len(data).bit_length() + 7) // 8, "big")
    return bytes([tag, 128 | len(size)]) + size + data


def certificate(subject: str | None, issuer: str, begin: str, end: str, names: Iterable[str] = (), version: int = 3, text: int = 0x0C) -> bytes:
    """A certificate without a real key or signature; times as YYMMDDHHMMSSZ or YYYYMMDDHHMMSSZ."""
    code = {0x0C: "utf-8", 0x13: "ascii", 0x1E: "utf-16-be"}[text]
    country = der(0x31, der(0x30, b"\x06\x03\x55\x04\x06", der(0x13, b"XX")))
    name = lambda cn: der(0x30, country, *([] if cn is None else [der(0x31, der(0x30, COMMON_NAME, der(text, cn.encode(code))))]))
    time = lambda t: der(0x17 if len(t) == 13 else 0x18, t.encode())
    names = list(names)
    general = der(0x30, *[der(0x82, n.encode()) for n in names], der(0x87, b"\x01\x02\x03\x04"))
    extensions = der(0xA3, der(0x30, der(0x30, b"\x06\x03\x55\x1d\x13\x01\x01\xff", der(0x04, der(0x30))), der(0x30, ALTERNATIVE_NAMES, der(0x04, general))))
    signed = der(
        0x30,
        *([der(0xA0, der(2, bytes([version - 1])))] if version > 1 else []),
        der(2, b"\x05"), ALGORITHM, name(issuer), der(0x30, time(begin), time(end)), name(subject), der(0x30, ALGORITHM, der(3, b"\0\1\2")),
        *([extensions] if names else []),
    )
    return der(0x30, signed, ALGORITHM, der(3, b"\0" + bytes(70)))


def certificate_text(*args, **fields) -> str:
    return base64.b64encode(certificate(*args, **fields)).decode()


def data_value(value) -> bytes:
    """A value of the data section of a range file."""
    if isinstance(value, dict):
        return _control(7, len(value)) + b"".join(data_value(k) + data_value(v) for k, v in value.items())
    if isinstance(value, list):
        return _control(11, len(value)) + b"".join(map(data_value, value))
    if isinstance(value, bool):
        return _control(14, int(value))
    if isinstance(value, int):
        raw = value.to_bytes((value.bit_length() + 7) // 8, "big")
        return _control(6 if value < 1 << 32 else 9, len(raw)) + raw
    raw = value.encode()
    return _control(2, len(raw)) + raw


def _control(kind: int, size: int) -> bytes:
    first, more = (size, b"") if size < 29 else (29, bytes([size - 29])) if size < 285 else (30, (size - 285).to_bytes(2, "big"))
    return (bytes([kind << 5 | first]) if kind < 8 else bytes([first, kind - 7])) + more


def networks(start: int, end: int) -> list[tuple[int, int]]:
    """(first address, prefix length) of the networks that make up a range."""
    out = []
    while start <= end:
        size = min(start & -start or 1 << 32, 1 << ((end - start + 1).bit_length() - 1))
        out.append((start, 33 - size.bit_length()))
        start += size
    return out


def range_file(ranges: Iterable[tuple[int, int, dict]], bits: int = 28, version: int = 6) -> bytes:
    """A search-tree file of disjoint ranges (start, end, record)."""
    nodes: list[list] = [[None, None]]
    data, places = b"", {}
    root = 0
    for _ in range(96 if version == 6 else 0):
        nodes.append([None, None])
        nodes[root][0] = ("node", len(nodes) - 1)
        root = len(nodes) - 1
    for start, end, record in ranges:
        raw = data_value(record)
        if raw not in places:
            places[raw] = len(data)
            data += raw
        for first, length in networks(start, end):
            at = root
            for depth in range(length - 1):
                bit = first >> (31 - depth) & 1
                if nodes[at][bit] is None:
                    nodes.append([None, None])
                    nodes[at][bit] = ("node", len(nodes) - 1)
                at = nodes[at][bit][1]
            nodes[at][first >> (32 - length) & 1] = ("data", places[raw])
    number = lambda c: len(nodes) if c is None else c[1] if c[0] == "node" else len(nodes) + 16 + c[1]
    tree = bytearray()
    for left, right in nodes:
        a, b = number(left), number(right)
        if bits == 28:
            tree += (a & 0xFFFFFF).to_bytes(3, "big") + bytes([(a >> 24) << 4 | b >> 24]) + (b & 0xFFFFFF).to_bytes(3, "big")
        else:
            tree += a.to_bytes(bits // 8, "big") + b.to_bytes(bits // 8, "big")
    about = {"node_count": len(nodes), "record_size": bits, "ip_version": version, "database_type": "authored", "languages": ["en"]}
    return bytes(tree) + bytes(16) + data + MARKER + data_value(about)
