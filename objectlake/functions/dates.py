"""Date functions of the query language (C-01..C-14), all built-in Spark."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

import datetime as _dt

from .expr import Expr, as_item, col_expr


class RangeFn(Expr):
    """A date function that only grows with its argument (year, fiscal year,
    day).  A comparison with a literal is rewritten as a half-open range on
    the argument itself — the same rows, but a predicate Parquet can use to
    skip row groups, where ``year(x) = 1997`` could not be pushed."""

    def __init__(self, name: str, arg: Expr, fn, start_of):
        self.arg, self.start_of = arg, start_of
        super().__init__(f"{name}({arg.key})", lambda r: fn(arg.to_column(r)), (arg,), is_function=True)

    def _cmp(self, other, sym, fn):
        value = other
        if isinstance(value, bool) or not isinstance(value, (int, _dt.date)):
            return super()._cmp(other, sym, fn)
        lo, hi = self.start_of(value), self.start_of(_next(value))
        arg = self.arg

        def build(r):
            c = arg.to_column(r)
            lo_l, hi_l = F.lit(lo), F.lit(hi)
            return {"=": (c >= lo_l) & (c < hi_l), "!=": (c < lo_l) | (c >= hi_l), "<": c < lo_l,
                    "<=": c < hi_l, ">": c >= hi_l, ">=": c >= lo_l}[sym]
        return Expr(f"({self.key} {sym} {value!r})", build, (self,))


def _next(v):
    return v + _dt.timedelta(days=1) if isinstance(v, _dt.date) else v + 1


def _int(c: Column) -> Column:
    return c.cast("int")


def _fiscal_shift(c: Column, fy_start: int) -> Column:
    """Move a date so the fiscal year starts in January."""
    if not 1 <= fy_start <= 12:
        raise ValueError("fy_start must be a month number 1..12")
    return F.add_months(F.to_date(c), -(fy_start - 1))


def calendar_month(f) -> Expr:
    return col_expr(lambda c: _int(F.month(c)), f, "CALENDAR_MONTH")


def calendar_quarter(f) -> Expr:
    return col_expr(lambda c: _int(F.quarter(c)), f, "CALENDAR_QUARTER")


def calendar_year(f) -> Expr:
    return RangeFn("CALENDAR_YEAR", as_item(f), lambda c: _int(F.year(c)), lambda y: _dt.date(y, 1, 1))


def day_in_month(f) -> Expr:
    return col_expr(lambda c: _int(F.dayofmonth(c)), f, "DAY_IN_MONTH")


def day_in_week(f) -> Expr:
    """1 = Sunday ... 7 = Saturday."""
    return col_expr(lambda c: _int(F.dayofweek(c)), f, "DAY_IN_WEEK")


def day_in_year(f) -> Expr:
    return col_expr(lambda c: _int(F.dayofyear(c)), f, "DAY_IN_YEAR")


def fiscal_month(f, fy_start: int = 1) -> Expr:
    return col_expr(lambda c: _int(F.month(_fiscal_shift(c, fy_start))), f, "FISCAL_MONTH")


def fiscal_quarter(f, fy_start: int = 1) -> Expr:
    return col_expr(lambda c: _int(F.quarter(_fiscal_shift(c, fy_start))), f, "FISCAL_QUARTER")


def fiscal_year(f, fy_start: int = 1, label: str = "start") -> Expr:
    """Fiscal year of the date; labelled by the calendar year the fiscal year
    starts in (``label="start"``) or ends in (``label="end"``)."""
    if label not in ("start", "end"):
        raise ValueError("label must be 'start' or 'end'")
    bump = 1 if (label == "end" and fy_start != 1) else 0
    return RangeFn("FISCAL_YEAR", as_item(f), lambda c: _int(F.year(_fiscal_shift(c, fy_start)) + bump),
                   lambda y: _dt.date(y - bump, fy_start, 1))


def hour_in_day(f) -> Expr:
    return col_expr(lambda c: _int(F.hour(c)), f, "HOUR_IN_DAY")


def week_in_month(f) -> Expr:
    """Days 1-7 are week 1, 8-14 week 2, ..."""
    return col_expr(lambda c: _int(F.ceil(F.dayofmonth(c) / F.lit(7))), f, "WEEK_IN_MONTH")


def week_in_year(f) -> Expr:
    """Days 1-7 of the year are week 1, ..."""
    return col_expr(lambda c: _int(F.ceil(F.dayofyear(c) / F.lit(7))), f, "WEEK_IN_YEAR")


def day_only(f) -> Expr:
    """The date part of a datetime."""
    return RangeFn("DAY_ONLY", as_item(f), lambda c: F.to_date(c), lambda d: d)


def convert_timezone(f, tz: str) -> Expr:
    """C-14: a UTC datetime shown in ``tz`` (wrap it in another date function)."""
    a = as_item(f)
    return Expr(f"convertTimezone({a.key},{tz})",
                lambda r: F.from_utc_timestamp(a.to_column(r).cast("timestamp"), tz)
                .cast(r.data_type(a.to_column(r))),
                (a,), is_function=True)
