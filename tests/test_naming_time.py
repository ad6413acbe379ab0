import datetime as dt

import pytest

from objectlake.functions.reldates import relative_range
from objectlake.functions.timefilter import DurationError, parse_duration, range_bounds
from objectlake.naming import normalize_name


@pytest.mark.parametrize("name,expected", [
    ("Account.Name", "Account_Name"), ("Name", "Name"), ("_x", "_x"), ("1abc", "A1abc"),
    ("Close Date", "Close_Date"), ("ä_field", "A__field"), ("a-b.c", "a_b_c"), ("", "A"),
])
def test_normalize_name(name, expected):
    assert normalize_name(name) == expected


def test_parse_duration_valid():
    assert parse_duration("1 days, 2 hours, 30 minutes") == {"DAYS": 1, "HOURS": 2, "MINUTES": 30}
    assert parse_duration("  ") == {}
    assert parse_duration(None) == {}
    assert parse_duration("3 Months,4 years") == {"MONTHS": 3, "YEARS": 4}
    assert parse_duration("0 hours") == {"HOURS": 0}


@pytest.mark.parametrize("text", ["2 abc", "HOURS HOURS", "1;HOURS", "1 HOURS,2", "1 days, 2 days", "-1 days"])
def test_parse_duration_invalid(text):
    with pytest.raises(DurationError):
        parse_duration(text)


def test_range_bounds():
    t = "2019-03-22T10:15:00Z"
    assert range_bounds(t, None, None) == (None, None)
    assert range_bounds(t, "0 hours", "0 days") == (None, None)
    assert range_bounds(t, "6 hours", None) == (dt.datetime(2019, 3, 22, 4, 15), dt.datetime(2019, 3, 22, 10, 15))
    assert range_bounds(t, None, "1 hours") == (None, dt.datetime(2019, 3, 22, 9, 15))
    assert range_bounds(t, "1 days", "2 hours") == (dt.datetime(2019, 3, 21, 8, 15), dt.datetime(2019, 3, 22, 8, 15))
    # months first whatever the order of the text (month ends differ)
    a = range_bounds("2019-03-31T00:00:00Z", "1 months, 1 days", None)
    b = range_bounds("2019-03-31T00:00:00Z", "1 days, 1 months", None)
    assert a == b == (dt.datetime(2019, 2, 27), dt.datetime(2019, 3, 31))


@pytest.mark.parametrize("lit,lo,hi", [
    ("TODAY", "1998-05-20", "1998-05-21"),
    ("THIS_WEEK", "1998-05-17", "1998-05-24"),
    ("LAST_N_DAYS:1", "1998-05-19", "1998-05-21"),
    ("NEXT_N_DAYS:0", "1998-05-21", "1998-05-21"),
    ("LAST_MONTH", "1998-04-01", "1998-05-01"),
    ("NEXT_N_YEARS:2", "1999-01-01", "2001-01-01"),
    ("LAST_90_DAYS", "1998-02-19", "1998-05-21"),
])
def test_relative_ranges(lit, lo, hi):
    assert relative_range(lit, "1998-05-20") == (dt.date.fromisoformat(lo), dt.date.fromisoformat(hi))


def test_relative_week_start_and_fiscal():
    # Monday-based week (2 = Monday in DAY_IN_WEEK numbering)
    assert relative_range("THIS_WEEK", "1998-05-20", week_start=2) == (dt.date(1998, 5, 18), dt.date(1998, 5, 25))
    assert relative_range("THIS_FISCAL_YEAR", "1998-02-10", fy_start=4) == (dt.date(1997, 4, 1), dt.date(1998, 4, 1))
    assert relative_range("LAST_FISCAL_QUARTER", "1998-02-10", fy_start=2) == (dt.date(1997, 11, 1), dt.date(1998, 2, 1))


@pytest.mark.parametrize("bad", ["LAST_N_DAYS", "LAST_N_DAYS:x", "SOMEDAY", "LAST_N_HOURS:3", "LAST_N_DAYS:-1"])
def test_relative_invalid(bad):
    with pytest.raises(ValueError):
        relative_range(bad, "1998-05-20")
