"""Dates.

Replica dates are ISO text ``YYYY-MM-DD``. Filters compare text with text so
they stay pushable into Parquet / JDBC scans; rolling windows are folded to
text literals on the driver from an ``as_of`` date.
"""
from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(as_of) -> _dt.date:
    if as_of is None:
        return _dt.date.today()
    if isinstance(as_of, _dt.datetime):
        return as_of.date()
    if isinstance(as_of, _dt.date):
        return as_of
    return _dt.date.fromisoformat(str(as_of))


def days_back(as_of, n: int) -> str:
    """``to_char(as_of - n, 'YYYY-MM-DD')`` as a literal string."""
    return (as_date(as_of) - _dt.timedelta(days=int(n))).isoformat()


def window_bounds(as_of, ini: int, fim: int) -> tuple[str, str]:
    """Text bounds of the rolling window ``[as_of - ini, as_of - fim]``."""
    return days_back(as_of, ini), days_back(as_of, fim)


def sap_date(x) -> Column:
    """Text date to timestamp; ``''`` and the ERP zero date ``'0000-00-00'`` become NULL."""
    c = F.nullif(F.nullif(_c(x), F.lit("")), F.lit("0000-00-00"))
    return c.try_cast("timestamp_ntz")


def render_decimal_ts(x) -> Column:
    """Decimal timestamp ``yyyymmddhhmmss.fffffff`` rendered ``dd-mm-yyyy``;
    the zero value renders as ``''``; NULL stays NULL."""
    s = _c(x).cast("decimal(21,7)").cast("string")
    return F.when(s == F.lit("0.0000000"), F.lit("")).otherwise(
        F.concat(F.substring(s, 7, 2), F.lit("-"), F.substring(s, 5, 2), F.lit("-"),
                 F.substring(s, 1, 4)))


def slice_count(ini: int, fim: int, size: int) -> int:
    """Number of day slices that the window ``ini..fim`` (days back) is cut into:
    full slices of ``size`` days, the last one with what is left."""
    return max(1, -(-(ini - fim) // size)) if size > 0 else 1


def slice_bounds(i: int, ini: int, fim: int, size: int) -> tuple[int, int]:
    """First and last day (days back, both included) of slice ``i``, 0 = oldest.

    Slice i begins ``i * size`` days after the window does and ends the day
    before the next one begins; the last ends with the window.
    """
    last = i == slice_count(ini, fim, size) - 1
    return ini - i * size, fim if last else ini - (i + 1) * size + 1


def day_slice_id(date_text, as_of, ini: int, fim: int, size: int) -> Column:
    """Index of the day slice a text date falls in (0 = oldest slice).

    Equivalent to running the window once per slice and concatenating, but
    as one column so a single job covers every slice.
    """
    n = slice_count(ini, fim, size)
    if n == 1:
        return F.lit(0)
    back = F.datediff(F.lit(as_date(as_of)), F.to_date(_c(date_text)))
    return F.least(F.floor((F.lit(ini) - back) / F.lit(size)).cast("int"), F.lit(n - 1))
