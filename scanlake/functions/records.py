"""Struct-valued columns: empty records, merging, tag flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlake.schemas import IP_METADATA_FIELDS, MATCHES_CONTROL, RESPONSE_FIELDS


def null_of(kind: str) -> Column:
    return F.lit(None).cast(kind)


def record(fields: list[tuple[str, str]], **values: Column) -> Column:
    """Struct with the given fields; a field without a value is null."""
    return F.struct(
        *[values.get(name, F.lit(None)).cast(kind).alias(name) for name, kind in fields]
    )


def ip_metadata(**values: Column) -> Column:
    return record(IP_METADATA_FIELDS, **values)


def response(**values: Column) -> Column:
    """Response struct; its two lists are empty rather than null."""
    empty = F.array().cast("array<string>")
    values.setdefault("tls_cert_alternative_names", empty)
    values.setdefault("headers", empty)
    return record(RESPONSE_FIELDS, **values)


def merge_non_null(base: Column, new: Column, fields: list[str]) -> Column:
    """Field by field, the new value where there is one, else the base value."""
    return F.struct(*[F.coalesce(new[f], base[f]).alias(f) for f in fields])


def merge_ip_metadata(base: Column, new: Column) -> Column:
    return merge_non_null(base, new, [name for name, _ in IP_METADATA_FIELDS])


def tags_to_flags(tags: Column) -> Column:
    """Tag list as a struct of true-or-null flags; null when there are no tags.

    ``array_contains`` leaves its loop by an exception inside other functions of arrays, ``exists`` does not.
    """
    flags = F.struct(
        *[
            F.when(F.exists(tags, lambda tag: tag == name), F.lit(True)).alias(name)  # noqa: B023
            for name in ("ip", "http", "cert", "asnum", "asname")
        ]
    )
    return F.when(F.size(tags) > 0, flags).cast(MATCHES_CONTROL)
