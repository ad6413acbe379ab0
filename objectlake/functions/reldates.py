"""Relative date literals (F-13) as half-open [start, end) date ranges.

Bounds are computed once on the driver from an explicit ``as_of`` date so a
query is reproducible; the data-side work is two comparisons that Parquet can
use as row-group filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The relative date names of the query language.
SINGLE_NAMES = (
    "YESTERDAY", "TODAY", "TOMORROW",
    "LAST_WEEK", "THIS_WEEK", "NEXT_WEEK",
    "LAST_MONTH", "THIS_MONTH", "NEXT_MONTH",
    "LAST_90_DAYS", "NEXT_90_DAYS",
    "THIS_QUARTER", "LAST_QUARTER", "NEXT_QUARTER",
    "THIS_YEAR", "LAST_YEAR", "NEXT_YEAR",
    "THIS_FISCAL_QUARTER", "LAST_FISCAL_QUARTER", "NEXT_FISCAL_QUARTER",
    "THIS_FISCAL_YEAR", "LAST_FISCAL_YEAR", "NEXT_FISCAL_YEAR",
)
N_UNITS = ("DAYS", "WEEKS", "MONTHS", "QUARTERS", "YEARS", "FISCAL_QUARTERS", "FISCAL_YEARS")


def _as_date(v) -> dt.date:
    if isinstance(v, dt.datetime):
        return v.date()
    if isinstance(v, dt.date):
        return v
    return dt.date.fromisoformat(str(v)[:10])


def add_months(d: dt.date, n: int) -> dt.date:
    """Calendar month arithmetic, clipping the day to the month's end."""
    m = d.month - 1 + n
    y = d.year + m // 12
    m = m % 12 + 1
    last = [31, 29 if (y % 4 == 0 and (y % 100 != 0 or y % 400 == 0)) else 28,
            31, 30, 31, 30, 31, 31, 30, 31, 30, 31][m - 1]
    return dt.date(y, m, min(d.day, last))


def _unit_start(d: dt.date, unit: str, week_start: int, fy_start: int) -> dt.date:
    if unit == "DAY":
        return d
    if unit == "WEEK":
        # week_start: 1 = Sunday ... 7 = Saturday (same numbering as DAY_IN_WEEK)
        dow = d.isoweekday() % 7 + 1
        return d - dt.timedelta(days=(dow - week_start) % 7)
    if unit == "MONTH":
        return d.replace(day=1)
    if unit == "QUARTER":
        return dt.date(d.year, (d.month - 1) // 3 * 3 + 1, 1)
    if unit == "YEAR":
        return dt.date(d.year, 1, 1)
    if unit in ("FISCAL_QUARTER", "FISCAL_YEAR"):
        shifted = add_months(d.replace(day=1), -(fy_start - 1))
        if unit == "FISCAL_QUARTER":
            base = dt.date(shifted.year, (shifted.month - 1) // 3 * 3 + 1, 1)
        else:
            base = dt.date(shifted.year, 1, 1)
        return add_months(base, fy_start - 1)
    raise ValueError(unit)


def _shift(d: dt.date, unit: str, n: int) -> dt.date:
    if unit == "DAY":
        return d + dt.timedelta(days=n)
    if unit == "WEEK":
        return d + dt.timedelta(days=7 * n)
    months = {"MONTH": 1, "QUARTER": 3, "YEAR": 12, "FISCAL_QUARTER": 3, "FISCAL_YEAR": 12}[unit]
    return add_months(d, months * n)


def relative_range(literal: str, as_of, week_start: int = 1,
                   fy_start: int = 1) -> tuple[dt.date, dt.date]:
    """The [start, end) dates a relative literal stands for on day ``as_of``."""
    today = _as_date(as_of)
    text = literal.strip().upper()
    if ":" in text:
        head, _, num = text.partition(":")
        try:
            n = int(num)
        except ValueError:
            raise ValueError(f"Invalid relative date literal '{literal}'") from None
        if n < 0:
            raise ValueError(f"Invalid relative date literal '{literal}'")
        parts = head.split("_", 2)
        if len(parts) != 3 or parts[0] not in ("LAST", "NEXT") or parts[1] != "N" or parts[2] not in N_UNITS:
            raise ValueError(f"Invalid relative date literal '{literal}'")
        unit = parts[2][:-1]
        if unit == "DAY":
            # LAST_N_DAYS:n covers the n days before today and today itself;
            # NEXT_N_DAYS:n starts tomorrow.
            if parts[0] == "LAST":
                return today - dt.timedelta(days=n), today + dt.timedelta(days=1)
            return today + dt.timedelta(days=1), today + dt.timedelta(days=1 + n)
        start = _unit_start(today, unit, week_start, fy_start)
        if parts[0] == "LAST":
            return _shift(start, unit, -n), start
        nxt = _shift(start, unit, 1)
        return nxt, _shift(nxt, unit, n)
    if text not in SINGLE_NAMES:
        raise ValueError(f"Invalid relative date literal '{literal}'")
    if text == "LAST_90_DAYS":
        return relative_range("LAST_N_DAYS:90", today)
    if text == "NEXT_90_DAYS":
        return relative_range("NEXT_N_DAYS:90", today)
    if text in ("YESTERDAY", "TODAY", "TOMORROW"):
        off = {"YESTERDAY": -1, "TODAY": 0, "TOMORROW": 1}[text]
        d = today + dt.timedelta(days=off)
        return d, d + dt.timedelta(days=1)
    which, unit = text.split("_", 1)
    start = _unit_start(today, unit, week_start, fy_start)
    start = _shift(start, unit, {"LAST": -1, "THIS": 0, "NEXT": 1}[which])
    return start, _shift(start, unit, 1)


def local_midnight_utc(day: dt.date, tz: str) -> dt.datetime:
    """The UTC wall-clock time of midnight starting ``day`` in zone ``tz``."""
    from zoneinfo import ZoneInfo

    local = dt.datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(tz))
    return local.astimezone(dt.timezone.utc).replace(tzinfo=None)


def compare_range(c: Column, lo, hi, op: str) -> Column:
    """Compare a date or datetime column with the range [lo, hi) (dates, or
    naive UTC datetimes):
    ``=`` inside, ``!=`` outside, ``<`` before start, ``>=`` from start,
    ``>`` from end, ``<=`` before end."""
    lo_l, hi_l = F.lit(lo), F.lit(hi)
    if op in ("=", "=="):
        return (c >= lo_l) & (c < hi_l)
    if op in ("!=", "<>"):
        return (c < lo_l) | (c >= hi_l)
    if op == "<":
        return c < lo_l
    if op == ">=":
        return c >= lo_l
    if op == ">":
        return c >= hi_l
    if op == "<=":
        return c < hi_l
    raise ValueError(f"Unsupported operator '{op}' for a relative date")
