"""Raw lines shared by all flatteners: ids, sources and malformed JSON."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scanlake.constants import (
    ANSWER_TAG_FILES,
    OBSERVATION_FILES,
    PAGE_FETCH_FILES,
    RESOLVER_TAG_FILES,
)
from scanlake.functions.paths import base_name, filename_matches
from scanlake.schemas import JSON_OPTIONS
from scanlake.sources.sinks import stage


def parse_json(text: Column, schema: str) -> Column:
    return F.from_json(text, schema, JSON_OPTIONS)


def _is_valid(scan: Column) -> Column:
    return scan.isNotNull() & scan["_corrupt_record"].isNull()


class DeadLetters(NamedTuple):
    """Where lines that cannot be parsed are kept, and the name under which parsed lines are staged for that."""

    path: str
    staging: str = "parsed"


def skip_malformed(lines: DataFrame, schema: str, counts: Observation | None = None, dead: DeadLetters | None = None) -> DataFrame:
    """Add ``scan``, the parsed line, and drop lines that are not valid JSON.

    ``lines`` has ``file_path`` and ``value``. The schema must end in
    ``_corrupt_record STRING``. The generator keeps the parser from being copied
    into a pushed-down filter, so each line is parsed once; ``counts`` gets the number
    of ``lines`` and of ``malformed`` ones from the same parse.

    With ``dead``, lines that are dropped are appended to a table (``dead_letters``). Two
    sinks read one parse then: the parsed lines are written once and both read them back.
    """
    parsed = F.array(parse_json(F.col("value"), schema))
    if counts is None and dead is None:
        return lines.select("*", F.explode(F.filter(parsed, _is_valid)).alias("scan"))
    valid = F.coalesce(_is_valid(F.col("scan")), F.lit(False))
    scans = lines.select("*", F.explode(parsed).alias("scan"))
    if counts is not None:
        scans = scans.observe(counts, F.count(F.lit(1)).alias("lines"), F.count_if(~valid).alias("malformed"))
    if dead is not None:
        scans = stage(scans, dead.staging)
        dead_letters(scans.filter(~valid)).write.mode("append").parquet(dead.path)
    return scans.filter(valid)


def dead_letters(bad: DataFrame) -> DataFrame:
    """Path, digest of the line, its length and the reason why it is no measurement."""
    is_json = F.try_parse_json("value").isNotNull()
    reason = (
        F.when(F.trim("value") == "", "no text")
        .when(is_json & ~F.ltrim("value").startswith("{"), "no object")
        .when(is_json, "a field of another type")
        .when(~F.rtrim("value").endswith("}"), "cut off")
        .otherwise("no JSON")
    )
    return bad.select("file_path", F.sha2("value", 256).alias("line_sha256"), F.length("value").alias("characters"), reason.alias("reason"))


def tests_before(tests: Column, index: Column) -> Column:
    """How many of the first ``index`` flags are true."""
    return F.size(F.filter(F.slice(tests, F.lit(1), index), lambda t: t)).cast("bigint")


# Input kinds of a DNS scan folder.
ANSWER_TAGS, RESOLVER_TAGS, PAGE_FETCHES, OBSERVATIONS = (
    "answer_tags",
    "resolver_tags",
    "page_fetches",
    "observations",
)


def input_kind(path: Column) -> Column:
    """Kind of a DNS input file by its name; an unknown name is an error."""
    return (
        F.when(filename_matches(path, ANSWER_TAG_FILES), ANSWER_TAGS)
        .when(filename_matches(path, RESOLVER_TAG_FILES), RESOLVER_TAGS)
        .when(filename_matches(path, PAGE_FETCH_FILES), PAGE_FETCHES)
        .when(filename_matches(path, OBSERVATION_FILES), OBSERVATIONS)
        .otherwise(F.raise_error(F.concat(F.lit("unknown DNS file name: "), base_name(path))))
    )


def route_by_filename(lines: DataFrame) -> dict[str, DataFrame]:
    """Split the lines of a DNS scan by input kind."""
    tagged = lines.withColumn("kind", input_kind(F.col("file_path")))
    return {
        kind: tagged.filter(F.col("kind") == kind).drop("kind")
        for kind in (ANSWER_TAGS, RESOLVER_TAGS, PAGE_FETCHES, OBSERVATIONS)
    }
