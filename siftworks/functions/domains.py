"""Domains as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siftworks import rules
from siftworks.functions.text import any_of, label0, quoted, strip


def host(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def reject_reason(domain: Column) -> Column:
    """Why a domain is filtered out: no_dot, length, format or no_signal; null if it stays. Cheap tests come first."""
    d = F.lower(strip(domain))
    root = label0(d)
    dashes = F.length(root) - F.length(F.replace(root, F.lit("-"), F.lit("")))
    digits = F.length(root) - F.length(F.regexp_replace(root, "[0-9]", ""))
    suffix = F.rlike(d, F.lit(f"(?:{quoted(rules.DOMAIN_SUFFIXES)})\\z"))
    return (
        F.when(d.isNull() | ~F.contains(d, F.lit(".")), "no_dot")
        .when(~F.length(root).between(3, 22), "length")
        .when((dashes > 1) | (digits > 3), "format")
        .when(~(suffix | any_of(root, rules.DOMAIN_KEYWORDS)), "no_signal")
    )


def is_premium(domain: Column) -> Column:
    return reject_reason(domain).isNull()
