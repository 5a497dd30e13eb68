"""Text fields of raw measurements."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlake.constants import CONTROL_DOMAINS, MEASUREMENT_NAMESPACE_HEX


def measurement_id(path: Column, line: Column) -> Column:
    """Version-5 UUID of path and line in the measurement namespace, as 32 hex digits."""
    text = F.concat(path, line)
    # Only text with bytes that are no UTF-8 is encoded anew, with replacement characters.
    encoded = F.when(F.is_valid_utf8(text), text.cast("binary")).otherwise(F.encode(text, "UTF-8"))
    digest = F.sha1(F.concat(F.unhex(F.lit(MEASUREMENT_NAMESPACE_HEX)), encoded))
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 12), F.lit("5"), F.substring(digest, 14, 3), variant, F.substring(digest, 18, 15)
    )


# Fixed value: shape of a request text, groups are path and host. Only a line feed
# ends a line for the dots (d), so other line separators belong to path and host.
REQUEST_PATTERN = r"(?d)GET (.*) HTTP/1.1\r\nHost: (.*)\r\n"


def domain_from_request(sent: Column) -> Column:
    """Domain (and path) a request text asked for; null when nothing was recorded."""
    parts = F.struct(
        F.regexp_extract(sent, REQUEST_PATTERN, 1).alias("path"),
        F.regexp_extract(sent, REQUEST_PATTERN, 2).alias("host"),
    )

    def join(host: Column, path: Column) -> Column:
        return F.when(path == "/", host).otherwise(F.concat(host, path))

    def rebuilt(p: Column) -> Column:
        unknown = F.raise_error(F.concat(F.lit("unknown request format: "), sent))
        # Some requests carry host and path in each other's place.
        return (
            F.when(p["host"] == "", unknown)
            .when(p["host"].startswith("/"), join(p["path"], p["host"]))
            .otherwise(join(p["host"], p["path"]))
        )

    # The one-element array holds the two parts, so each is searched once.
    request = F.get(F.transform(F.array(parts), rebuilt), F.lit(0))
    return F.when(sent != "", F.when(sent.contains(" "), request).otherwise(sent))


def is_control_domain(domain: Column) -> Column:
    return F.coalesce(domain.isin(*CONTROL_DOMAINS), F.lit(False))


def flatten_headers(headers: Column) -> Column:
    """``map<name, values>`` to an array of ``name: value`` in map order."""
    lists = F.transform(
        F.map_entries(headers),
        lambda entry: F.transform(entry["value"], lambda v: F.concat(entry["key"], F.lit(": "), v)),
    )
    return F.coalesce(F.flatten(lists), F.array().cast("array<string>"))


def http_response_text(status: Column, headers: Column, body: Column) -> Column:
    """Rebuild a response from its parts: status, header lines, blank line, body."""
    head = F.array_join(F.transform(headers, lambda h: F.concat(h, F.lit("\r\n"))), "")
    return F.concat(
        F.coalesce(status, F.lit("")), F.lit("\r\n"), head, F.lit("\r\n"), F.coalesce(body, F.lit(""))
    )


def iso_timestamp(text: Column) -> Column:
    """``2021-04-18 14:49:01.62 -0400 EDT m=+10.5`` to ``2021-04-18T14:49:01.62-04:00``."""
    text = F.trim(text)

    def part(number: int) -> Column:
        return F.substring_index(F.substring_index(text, " ", number), " ", -1)

    zone = part(3)
    return F.concat(
        part(1), F.lit("T"), part(2), F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, 4, 2)
    )


def url_host(url: Column) -> Column:
    """Everything before the first ``/``, ``?`` or ``#`` of a scheme-less url."""
    return F.regexp_extract(url, r"^([^/?#]*)", 1)


def spaced_json(compact: Column) -> Column:
    """Compact JSON text with a space after each structural comma and colon."""
    return F.regexp_replace(compact, r'\G((?:"(?:[^"\\]|\\.)*+"|[^":,])*+)([:,])', "$1$2 ")
