"""What a file path says: base name, source, scan type, date."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlake.constants import SCAN_TYPE_MARKERS


def base_name(path: Column) -> Column:
    """Last path component, without a trailing ``.gz``."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.gz$", "")


def filename_matches(path: Column, allowed: Sequence[str]) -> Column:
    return base_name(path).isin(*allowed)


def source_of(path: Column) -> Column:
    """Name of the folder that holds the file; empty when there is none."""
    return F.coalesce(F.try_element_at(F.split(path, "/"), F.lit(-2)), F.lit(""))


def scan_type_of(source: Column) -> Column:
    """Scan type named in a source; https is tested before http."""
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for marker, scan_type in SCAN_TYPE_MARKERS:
        chain = chain.when(source.contains(marker), scan_type)
    return chain.otherwise(
        F.raise_error(F.concat(F.lit("unknown scan type: "), F.coalesce(source, F.lit("null"))))
    )


def loose_scan_type_of(source: Column) -> Column:
    """Scan type of a probe source by the bare protocol name."""
    chain = F.when(F.lit(False), F.lit(None).cast("string"))
    for name in ("echo", "discard", "https", "http"):
        chain = chain.when(source.contains(name), name)
    return chain.otherwise(
        F.raise_error(F.concat(F.lit("unknown scan type: "), F.coalesce(source, F.lit("null"))))
    )


def path_date(path: Column) -> Column:
    """First ``dddd-dd-dd`` in the path as a date; null when there is none."""
    return F.regexp_extract(path, r"(\d{4}-\d{2}-\d{2})", 1).try_cast("date")


def between_dates(path: Column, start: str | None = None, end: str | None = None) -> Column:
    """True when the path date lies in the inclusive range; either side may be open."""
    day = path_date(path)
    inside = day.isNotNull()
    if start is not None:
        inside = inside & (day >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (day <= F.lit(end).cast("date"))
    return inside
