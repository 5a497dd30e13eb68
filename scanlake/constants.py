"""Fixed values of the data formats: names, dates and lists that results depend on."""

from __future__ import annotations

# Fixed value: namespace of the version-5 measurement ids, as hex.
MEASUREMENT_NAMESPACE_HEX = "e49764863ca753b9b125cfb6dabec780"

# Domains that are control measurements.
CONTROL_DOMAINS = [
    "example5718349450314.com",
    "rtyutgyhefdafioasfjhjhi.com",
    "a.root-servers.net",
    "www.example.com",
    "gstatic.com",
    "yr-in-f94.1e100.net",
    "captive.apple.com",
    "usmia1-vip-bx-006.aaplimg.com",
    "cse.engin.umich.edu",
    "eecs.umich.edu",
]

# Resolvers that are control resolvers.
CONTROL_RESOLVERS = ["1.1.1.1", "8.8.8.8", "8.8.4.4", "64.6.64.6", "64.6.65.6"]

# First day of the second DNS format and of its second revision.
DNS_V2_START = "2021-03-01"
DNS_V2_2_START = "2021-06-24"

# Fixed value: DNS files dated earlier are never loaded.
EARLIEST_DNS_FILE = "2022-05-01"

# Fixed value: a gzip file of this size (bytes) or less holds no data.
EMPTY_GZIP_BYTES = 33

# Fixed value: a route snapshot may be this many days older than the data.
STALE_SNAPSHOT_DAYS = 5

# File names of each input kind.
PROBE_FILES = ["results.json"]
DNS_CONTROL_V1_FILE = "answers_control.json"
DNS_CONTROL_V2_FILE = "responses_control.json"
ANSWER_TAG_FILES = ["tagged_answers.json", "tagged_responses.json"]
RESOLVER_TAG_FILES = ["resolvers.json", "tagged_resolvers.json", "resolvers_profile.json"]
PAGE_FETCH_FILES = ["blockpages.json", "control_pages.json"]
OBSERVATION_FILES = [
    "interference.json",
    "interference_err.json",
    "answers_control.json",
    "responses_control.json",
    "results.json",
    "answers_err.json",
]
DNS_FILES = RESOLVER_TAG_FILES + ANSWER_TAG_FILES + PAGE_FETCH_FILES + OBSERVATION_FILES

# Path substring of each scan type, tested in this order.
SCAN_TYPE_MARKERS = [
    ("Quack-echo", "echo"),
    ("Quack-discard", "discard"),
    ("Quack-https", "https"),
    ("Quack-http", "http"),
    ("Satellite", "satellite"),
]
DNS_PATH_MARKER = "Satellite"

# AS names starting with one of these are content networks.
CDN_NAME_PREFIXES = ["AMAZON", "Akamai", "OPENDNS", "CLOUDFLARENET", "GOOGLE"]

# Fixed value: a resolver failing more often than this is left out.
BAD_RESOLVER_RATE = 0.75
