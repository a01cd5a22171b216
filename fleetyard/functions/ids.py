"""Identifier normalisation.

ERP identifiers are fixed-width text with leading zeros and, in replicas,
sometimes padded with blanks. They stay strings: never cast them to numbers
to join.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip_zeros(x) -> Column:
    """Trim blanks, then drop leading zeros. ``'000'`` gives ``''``; NULL stays NULL."""
    return F.ltrim(F.trim(_c(x)), F.lit("0"))


def blank_to_null(x) -> Column:
    """``nullif(trim(x), '')``."""
    return F.nullif(F.trim(_c(x)), F.lit(""))


def norm_id(x) -> Column:
    """Zero-stripped id with blank turned into NULL (all-zero ids become NULL)."""
    return F.nullif(strip_zeros(x), F.lit(""))


def not_blank(x) -> Column:
    """``x IS NOT NULL AND trim(x) <> ''`` (NULL compares as false)."""
    c = _c(x)
    return c.isNotNull() & (F.trim(c) != F.lit(""))


def norm_code(x) -> Column:
    """Tolerant code: ``upper(trim(coalesce(x, '')))``."""
    return F.upper(F.trim(F.coalesce(_c(x), F.lit(""))))


def is_code_in(x, codes) -> Column:
    """Tolerant membership test, e.g. object type in ('A', '')."""
    return norm_code(x).isin(list(codes))


def branch_of(code) -> Column:
    """Branch = text before the first ``|``; if that is empty, the whole code."""
    c = _c(code)
    return F.coalesce(F.nullif(F.split_part(c, F.lit("|"), F.lit(1)), F.lit("")), c)


def reservation_key(rsnum, rspos) -> Column:
    """10-digit reservation number followed by 4-digit item (lpad also truncates)."""
    return F.concat(F.lpad(F.trim(_c(rsnum)), 10, "0"), F.lpad(F.trim(_c(rspos)), 4, "0"))
