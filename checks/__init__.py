"""Registered queries: every operator over relations derived from the given tables.

Each query has a Spark side, which runs the operator, and an SQL side, which
states the expected result directly on the tables.
"""

from checks.common import REGISTRY
from checks import analysis, answers, dashboard, flatten, ingest, networks, tables, text  # noqa: F401

__all__ = ["REGISTRY"]
