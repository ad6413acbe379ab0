"""Relative date ranges against an independent definition by period index."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st

from objectlake.functions.reldates import relative_range


def _week(d, week_start):
    # days since a fixed Sunday, shifted so weeks start on week_start (1 = Sunday)
    base = dt.date(1899, 12, 31) + dt.timedelta(days=week_start - 1)   # 1899-12-31 was a Sunday
    return (d - base).days // 7


def _month(d):
    return d.year * 12 + d.month - 1


def _fiscal_month(d, fy):
    return _month(d) - (fy - 1)


def _index(d, unit, week_start, fy):
    if unit == "DAY":
        return d.toordinal()
    if unit == "WEEK":
        return _week(d, week_start)
    if unit == "MONTH":
        return _month(d)
    if unit == "QUARTER":
        return _month(d) // 3
    if unit == "YEAR":
        return d.year
    if unit == "FISCAL_QUARTER":
        return _fiscal_month(d, fy) // 3
    return _fiscal_month(d, fy) // 12          # FISCAL_YEAR


def _inside(literal, today, d, week_start, fy):
    if ":" in literal:
        head, n = literal.split(":")
        n = int(n)
        which, unit = head.split("_N_")
        unit = unit[:-1]
        if unit == "DAY":
            return (today - dt.timedelta(days=n) <= d <= today) if which == "LAST" else \
                (today < d <= today + dt.timedelta(days=n))
        i, t = _index(d, unit, week_start, fy), _index(today, unit, week_start, fy)
        return (t - n <= i < t) if which == "LAST" else (t < i <= t + n)
    if literal in ("YESTERDAY", "TODAY", "TOMORROW"):
        return (d - today).days == {"YESTERDAY": -1, "TODAY": 0, "TOMORROW": 1}[literal]
    if literal == "LAST_90_DAYS":
        return today - dt.timedelta(days=90) <= d <= today
    if literal == "NEXT_90_DAYS":
        return today < d <= today + dt.timedelta(days=90)
    which, unit = literal.split("_", 1)
    i, t = _index(d, unit, week_start, fy), _index(today, unit, week_start, fy)
    return i - t == {"LAST": -1, "THIS": 0, "NEXT": 1}[which]


UNITS = ["DAYS", "WEEKS", "MONTHS", "QUARTERS", "YEARS", "FISCAL_QUARTERS", "FISCAL_YEARS"]
SINGLES = ["YESTERDAY", "TODAY", "TOMORROW", "LAST_90_DAYS", "NEXT_90_DAYS"] + [
    f"{w}_{u}" for w in ("LAST", "THIS", "NEXT")
    for u in ("WEEK", "MONTH", "QUARTER", "YEAR", "FISCAL_QUARTER", "FISCAL_YEAR")]


@settings(max_examples=400, deadline=None)
@given(st.dates(dt.date(1990, 1, 1), dt.date(2030, 12, 31)),
       st.one_of(st.sampled_from(SINGLES),
                 st.builds(lambda w, u, n: f"{w}_N_{u}:{n}", st.sampled_from(["LAST", "NEXT"]),
                           st.sampled_from(UNITS), st.integers(0, 30))),
       st.integers(1, 7), st.integers(1, 12), st.integers(-1500, 1500))
def test_relative_range_matches_period_definition(today, literal, week_start, fy, delta):
    lo, hi = relative_range(literal, today, week_start=week_start, fy_start=fy)
    one = dt.timedelta(days=1)
    for d in (today + dt.timedelta(days=delta), lo - one, lo, hi - one, hi):
        assert (lo <= d < hi) == _inside(literal, today, d, week_start, fy), (literal, today, d, lo, hi)
