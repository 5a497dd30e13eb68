"""Explicit read schemas of the raw formats and the structs rows are made of."""

from __future__ import annotations

# JSON is parsed with explicit options: it keeps one parse per line (the schema
# pruning rule would otherwise clone the parser for every extracted field).
JSON_OPTIONS = {"mode": "PERMISSIVE"}

# Roundtrips stay raw text on the first parse; see operators.probe.
PROBE_LINE = (
    "Server STRING, Keyword STRING, Retries BIGINT, Blocked BOOLEAN, FailSanity BOOLEAN, "
    "StatefulBlock BOOLEAN, Results ARRAY<STRING>, "
    "vp STRING, test_url STRING, anomaly BOOLEAN, controls_failed BOOLEAN, "
    "stateful_block BOOLEAN, response ARRAY<STRING>, _corrupt_record STRING"
)
PROBE_V1_ROUNDTRIP = (
    "Sent STRING, Success BOOLEAN, Error STRING, StartTime STRING, EndTime STRING, Received STRING"
)
PROBE_V2_ROUNDTRIP = (
    "matches_template BOOLEAN, control_url STRING, error STRING, "
    "start_time STRING, end_time STRING, response STRING"
)
RECEIVED = (
    "status_line STRING, headers MAP<STRING, ARRAY<STRING>>, body STRING, "
    "tls STRUCT<version: BIGINT, cipher_suite: BIGINT, cert: STRING>, "
    "TlsVersion BIGINT, CipherSuite BIGINT, Certificate STRING"
)

DNS_LINE = (
    "resolver STRING, ip STRING, query STRING, passed BOOLEAN, answers STRING, error STRING, "
    "vp STRING, test_url STRING, location STRUCT<country_name: STRING, country_code: STRING>, "
    "response STRING, passed_control BOOLEAN, passed_liveness BOOLEAN, connect_error BOOLEAN, "
    "anomaly BOOLEAN, excluded BOOLEAN, exclude_reason ARRAY<STRING>, "
    "confidence STRUCT<average: DOUBLE, matches: ARRAY<DOUBLE>, "
    "untagged_controls: BOOLEAN, untagged_response: BOOLEAN>, "
    "start_time STRING, end_time STRING, _corrupt_record STRING"
)
DNS_TAG_MAP = "MAP<STRING, ARRAY<STRING>>"
DNS_ROUNDTRIPS = (
    "ARRAY<STRUCT<url: STRING, has_type_a: BOOLEAN, error: STRING, rcode: BIGINT, "
    "response: MAP<STRING, STRUCT<http: STRING, cert: STRING, asnum: BIGINT, asname: STRING, "
    "matched: ARRAY<STRING>>>>>"
)
DNS_CONTROL_ROUNDTRIPS = (
    "ARRAY<STRUCT<url: STRING, has_type_a: BOOLEAN, response: ARRAY<STRING>, error: STRING, "
    "rcode: BIGINT, start_time: STRING, end_time: STRING>>"
)
PAGE_FETCH_LINE = (
    "ip STRING, keyword STRING, fetched BOOLEAN, trusted_cert BOOLEAN, start_time STRING, "
    "end_time STRING, http STRING, https STRING, _corrupt_record STRING"
)
RESOLVER_TAG_LINE = (
    "resolver STRING, vp STRING, name STRING, country STRING, "
    "location STRUCT<country_name: STRING, country_code: STRING>, "
    "non_zero_rcode STRING, private_ip STRING, zero_ip STRING, connect_error STRING, "
    "invalid_cert STRING, _corrupt_record STRING"
)
ANSWER_TAG_LINE = (
    "ip STRING, http STRING, cert STRING, asname STRING, asnum BIGINT, _corrupt_record STRING"
)

# Structs of flattened rows, as (field, type) lists.
IP_METADATA_FIELDS = [
    ("netblock", "STRING"),
    ("asn", "BIGINT"),
    ("as_name", "STRING"),
    ("as_full_name", "STRING"),
    ("as_class", "STRING"),
    ("country", "STRING"),
    ("organization", "STRING"),
    ("name", "STRING"),
    ("non_zero_rcode_rate", "DOUBLE"),
    ("private_ip_rate", "DOUBLE"),
    ("zero_ip_rate", "DOUBLE"),
    ("connect_error_rate", "DOUBLE"),
    ("invalid_cert_rate", "DOUBLE"),
]
RESPONSE_FIELDS = [
    ("is_known_blockpage", "BOOLEAN"),
    ("page_signature", "STRING"),
    ("status", "STRING"),
    ("body", "STRING"),
    ("tls_version", "BIGINT"),
    ("tls_cipher_suite", "BIGINT"),
    ("tls_cert", "STRING"),
    ("tls_cert_common_name", "STRING"),
    ("tls_cert_issuer", "STRING"),
    ("tls_cert_start_date", "STRING"),
    ("tls_cert_end_date", "STRING"),
    ("tls_cert_alternative_names", "ARRAY<STRING>"),
    ("tls_cert_has_trusted_ca", "BOOLEAN"),
    ("tls_cert_matches_domain", "BOOLEAN"),
    ("headers", "ARRAY<STRING>"),
]
MATCHES_CONTROL_FIELDS = [
    ("ip", "BOOLEAN"),
    ("http", "BOOLEAN"),
    ("cert", "BOOLEAN"),
    ("asnum", "BOOLEAN"),
    ("asname", "BOOLEAN"),
]


def struct_ddl(fields: list[tuple[str, str]]) -> str:
    return "STRUCT<" + ", ".join(f"{name}: {kind}" for name, kind in fields) + ">"


IP_METADATA = struct_ddl(IP_METADATA_FIELDS)
RESPONSE = struct_ddl(RESPONSE_FIELDS)
MATCHES_CONTROL = struct_ddl(MATCHES_CONTROL_FIELDS)
ANSWER_FIELDS = [
    ("ip", "STRING"),
    ("http", "STRING"),
    ("cert", "STRING"),
    ("matches_control", MATCHES_CONTROL),
    ("match_confidence", "DOUBLE"),
    ("ip_metadata", IP_METADATA),
    ("http_response", RESPONSE),
    ("http_error", "STRING"),
    ("https_response", RESPONSE),
    ("https_error", "STRING"),
]
ANSWER = struct_ddl(ANSWER_FIELDS)

# Output tables, one row per roundtrip.
PROBE_TABLE = (
    "domain STRING, domain_category STRING, domain_is_control BOOLEAN, "
    "date DATE, start_time TIMESTAMP, end_time TIMESTAMP, retry BIGINT, "
    "server_ip STRING, server_netblock STRING, server_asn BIGINT, server_as_name STRING, "
    "server_as_full_name STRING, server_as_class STRING, server_country STRING, "
    "server_organization STRING, received_error STRING, received_tls_version BIGINT, "
    "received_tls_cipher_suite BIGINT, received_tls_cert STRING, "
    "received_tls_cert_matches_domain BOOLEAN, received_tls_cert_common_name STRING, "
    "received_tls_cert_issuer STRING, received_tls_cert_alternative_names ARRAY<STRING>, "
    "received_status STRING, received_headers ARRAY<STRING>, received_body STRING, "
    "is_known_blockpage BOOLEAN, page_signature STRING, outcome STRING, "
    "matches_template BOOLEAN, no_response_in_measurement_matches_template BOOLEAN, "
    "controls_failed BOOLEAN, stateful_block BOOLEAN, measurement_id STRING, source STRING"
)
DNS_TABLE_ANSWER = (
    "STRUCT<ip: STRING, asn: BIGINT, as_name: STRING, ip_organization: STRING, "
    "censys_http_body_hash: STRING, censys_ip_cert: STRING, "
    "matches_control: STRUCT<ip: BOOLEAN, censys_http_body_hash: BOOLEAN, "
    "censys_ip_cert: BOOLEAN, asn: BOOLEAN, as_name: BOOLEAN>, match_confidence: DOUBLE, "
    "http_error: STRING, http_response_status: STRING, http_response_headers: ARRAY<STRING>, "
    "http_response_body: STRING, http_analysis_is_known_blockpage: BOOLEAN, "
    "http_analysis_page_signature: STRING, https_error: STRING, https_tls_version: BIGINT, "
    "https_tls_cipher_suite: BIGINT, https_tls_cert: STRING, https_tls_cert_common_name: STRING, "
    "https_tls_cert_issuer: STRING, https_tls_cert_start_date: TIMESTAMP, "
    "https_tls_cert_end_date: TIMESTAMP, https_tls_cert_alternative_names: ARRAY<STRING>, "
    "https_tls_cert_has_trusted_ca: BOOLEAN, https_tls_cert_matches_domain: BOOLEAN, "
    "https_response_status: STRING, https_response_headers: ARRAY<STRING>, "
    "https_response_body: STRING, https_analysis_is_known_blockpage: BOOLEAN, "
    "https_analysis_page_signature: STRING>"
)
DNS_TABLE = (
    "domain STRING, domain_category STRING, domain_is_control BOOLEAN, "
    "date DATE, start_time TIMESTAMP, end_time TIMESTAMP, retry BIGINT, "
    "resolver_ip STRING, resolver_name STRING, resolver_is_trusted BOOLEAN, "
    "resolver_netblock STRING, resolver_asn BIGINT, resolver_as_name STRING, "
    "resolver_as_full_name STRING, resolver_as_class STRING, resolver_country STRING, "
    "resolver_organization STRING, resolver_non_zero_rcode_rate DOUBLE, "
    "resolver_private_ip_rate DOUBLE, resolver_zero_ip_rate DOUBLE, "
    "resolver_connect_error_rate DOUBLE, resolver_invalid_cert_rate DOUBLE, "
    "received_error STRING, received_rcode BIGINT, "
    f"answers ARRAY<{DNS_TABLE_ANSWER}>, "
    "success BOOLEAN, anomaly BOOLEAN, domain_controls_failed BOOLEAN, "
    "average_confidence DOUBLE, untagged_controls BOOLEAN, untagged_response BOOLEAN, "
    "excluded BOOLEAN, exclude_reason STRING, has_type_a BOOLEAN, "
    "measurement_id STRING, source STRING"
)
