"""Outcome of a DNS roundtrip."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scanlake.constants import BAD_RESOLVER_RATE
from scanlake.functions.ips import invalid_ip_type
from scanlake.functions.outcomes import EXPECTED, FAILED, UNCERTAIN, UNEXPECTED

# Names of the DNS response codes 1 to 23.
RCODE_NAMES = [
    "FormErr", "ServFail", "NXDomain", "NotImp", "Refused", "YXDomain", "YXRRSet", "NXRRSet",
    "NotAuth", "NotZone", "DSOTYPENI", "Unassigned", "Unassigned", "Unassigned", "Unassigned",
    "BadVers", "BadSig", "BadKey", "BadTime", "BadMode", "BadAlg", "BadTrunc", "BadCookie",
]
# Fixed value: server failures may have innocent causes.
UNCERTAIN_RCODE = 2

# Fixed values, in evaluation order: comparison, error text, outcome.
DNS_ERROR_RULES: list[tuple[str, str, str]] = [
    ("contains", '"Err": {}', UNCERTAIN + "dns.timedout"),
    ("contains", '"Err": 90', UNEXPECTED + "dns.msgsize"),
    ("contains", '"Err": 111', UNEXPECTED + "dns.connrefused"),
    ("contains", '"Err": 113', FAILED + "dns.hostunreach"),
    ("contains", '"Err": 24', FAILED + "setup.system_failure"),
    ("equals", "{}", UNEXPECTED + "dns.unknown"),
    ("equals", "no_answer", UNEXPECTED + "dns.no_answer"),
    ("suffix", "i/o timeout", UNCERTAIN + "dns.timedout"),
    ("suffix", "message too long", UNEXPECTED + "dns.msgsize"),
    ("suffix", "connection refused", UNEXPECTED + "dns.connrefused"),
    ("suffix", "no route to host", FAILED + "dns.hostunreach"),
    ("suffix", "short read", UNEXPECTED + "dns.msgsize"),
    ("suffix", "read: protocol error", UNEXPECTED + "dns.protocol_error"),
    ("suffix", "socket: too many open files", FAILED + "setup.system_failure"),
]
# Fixed value: this label carries the emoji selector twice.
BAD_DOMAIN_LABEL = UNEXPECTED + "\ufe0ftls.baddomain:"


def classify_rcode(rcode: Column) -> Column:
    """Outcome of a non-zero response code."""
    names = F.array(
        *[
            F.lit((UNCERTAIN if code == UNCERTAIN_RCODE else UNEXPECTED) + "dns.error:" + name)
            for code, name in enumerate(RCODE_NAMES, start=1)
        ]
    )
    known = F.get(names, (rcode - 1).cast("int"))
    unknown = F.concat(F.lit(UNEXPECTED + "dns.unknown_rcode:"), rcode.cast("string"))
    return F.coalesce(known, unknown)


def classify_dns_error(error: Column) -> Column:
    """Outcome of a resolver error text."""
    outcome = F.when(F.lit(False), F.lit(None).cast("string"))
    for how, text, label in DNS_ERROR_RULES:
        hit = {
            "contains": error.contains(text),
            "equals": error == text,
            "suffix": error.endswith(text),
        }[how]
        outcome = outcome.when(hit, label)
    return outcome.otherwise(F.concat(F.lit(UNEXPECTED + "unknown_error:"), error))


def any_true(items: Column, predicate) -> Column:
    """Logical OR over an array, nulls ignored; null when nothing is known."""
    known = F.filter(F.transform(items, predicate), lambda v: v.isNotNull())
    return F.when(F.size(known) > 0, F.exists(known, lambda v: v))


def all_true(items: Column, predicate) -> Column:
    """Logical AND over an array, nulls ignored; null when nothing is known."""
    known = F.filter(F.transform(items, predicate), lambda v: v.isNotNull())
    return F.when(F.size(known) > 0, F.forall(known, lambda v: v))


def answers_signature(answers: Column) -> Column:
    """Distinct networks of the answers, comma joined in order of first appearance."""
    names = F.transform(
        answers,
        lambda a: F.when(a["as_name"] != "", a["as_name"])
        .when(a["asn"].isNotNull(), F.concat(F.lit("AS"), a["asn"].cast("string")))
        .otherwise("missing_as_info"),
    )
    return F.array_join(F.array_distinct(names), ",")


def is_bad_resolver(connect_error: Column, invalid_cert: Column, non_zero_rcode: Column) -> Column:
    """Three-valued: null when no rate is high and some rate is missing."""
    return (
        (connect_error > BAD_RESOLVER_RATE)
        | (invalid_cert > BAD_RESOLVER_RATE)
        | (non_zero_rcode > BAD_RESOLVER_RATE)
    )


def dns_outcome(error: Column, rcode: Column, answers: Column) -> Column:
    """Marked outcome of a DNS roundtrip from its error, code and answers."""
    answers = F.coalesce(answers, F.array())
    first = F.get(answers, F.lit(0))
    has_error = error.isNotNull() & ~error.isin("", "null", "SERVFAIL")
    matches = lambda a: a["https_tls_cert_matches_domain"]
    trusted = lambda a: a["https_tls_cert_has_trusted_ca"]
    by_content = (
        F.when(any_true(answers, lambda a: a["matches_control"]["ip"]), EXPECTED + "ip.matchip")
        .when(any_true(answers, lambda a: matches(a) & trusted(a)), EXPECTED + "tls.validcert")
        .when(
            any_true(answers, lambda a: matches(a) & ~trusted(a)),
            F.concat(F.lit(UNEXPECTED + "tls.badca:"), first["https_tls_cert_issuer"]),
        )
        .when(
            all_true(answers, lambda a: ~matches(a)),
            F.concat(F.lit(BAD_DOMAIN_LABEL), first["https_tls_cert_common_name"]),
        )
        .when(
            any_true(answers, lambda a: a["http_analysis_is_known_blockpage"]),
            F.concat(F.lit(UNEXPECTED + "http.blockpage:"), first["http_analysis_page_signature"]),
        )
        .when(any_true(answers, lambda a: a["matches_control"]["asn"]), EXPECTED + "ip.matchasn")
        .otherwise(F.concat(F.lit(UNCERTAIN + "tls.connerror:"), answers_signature(answers)))
    )
    return (
        F.when(has_error, classify_dns_error(error))
        .when(rcode == -1, UNCERTAIN + "dns.timedout")
        .when(rcode != 0, classify_rcode(rcode))
        .when(F.size(answers) == 0, UNEXPECTED + "ip.empty")
        .otherwise(F.coalesce(invalid_ip_type(first["ip"]), by_content))
    )
