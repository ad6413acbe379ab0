"""Field expressions, predicates, aggregates and date functions."""

from .aggregates import avg_, count_, count_distinct_, grouping_, max_, min_, sum_
from .dates import (calendar_month, calendar_quarter, calendar_year, convert_timezone, day_in_month,
                    day_in_week, day_in_year, day_only, fiscal_month, fiscal_quarter, fiscal_year,
                    hour_in_day, week_in_month, week_in_year)
from .expr import Expr, and_, fld, func, lit, not_, or_, param
from .reldates import relative_range
from .timefilter import parse_duration, range_bounds

__all__ = [
    "Expr", "fld", "lit", "param", "func", "and_", "or_", "not_",
    "min_", "max_", "sum_", "avg_", "count_", "count_distinct_", "grouping_",
    "calendar_month", "calendar_quarter", "calendar_year", "day_in_month", "day_in_week",
    "day_in_year", "fiscal_month", "fiscal_quarter", "fiscal_year", "hour_in_day",
    "week_in_month", "week_in_year", "day_only", "convert_timezone",
    "relative_range", "parse_duration", "range_bounds",
]
