"""Small labels of the dashboard and analysis tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def mask_control_domain(domain: Column, is_control: Column) -> Column:
    return F.when(is_control, "CONTROL").otherwise(domain)


def category_or_default(category: Column) -> Column:
    return F.coalesce(category, F.lit("Uncategorized"))


def subnetwork_label(asn: Column, organization: Column) -> Column:
    """``AS<n>`` or ``AS<n> - <organisation>``; null without a number."""
    suffix = F.coalesce(F.concat(F.lit(" - "), organization), F.lit(""))
    return F.concat(F.lit("AS"), asn.cast("string"), suffix)


def label_result(
    result: Column, success: Sequence[str], interference: Sequence[str], system_error: Sequence[str]
) -> Column:
    """Group raw result texts into success, interference, system_error or unknown."""
    return (
        F.when(result.isin(*success), "success")
        .when(result.isin(*interference), "interference")
        .when(result.isin(*system_error), "system_error")
        .otherwise("unknown")
    )
