"""Modified-time filters: interval (F-09), range (F-10) and duration text (F-11)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .reldates import add_months

# Duration units accepted in duration text, with their length.
# Calendar units (months and longer) are applied with calendar arithmetic.
FIXED_UNITS = {
    "NANOS": None,      # 1/1000 of a microsecond, see _minus
    "MICROS": dt.timedelta(microseconds=1),
    "MILLIS": dt.timedelta(milliseconds=1),
    "SECONDS": dt.timedelta(seconds=1),
    "MINUTES": dt.timedelta(minutes=1),
    "HOURS": dt.timedelta(hours=1),
    "HALF_DAYS": dt.timedelta(hours=12),
    "DAYS": dt.timedelta(days=1),
    "WEEKS": dt.timedelta(weeks=1),
}
CALENDAR_UNITS = {"MONTHS": 1, "YEARS": 12, "DECADES": 120, "CENTURIES": 1200, "MILLENNIA": 12000}
UNIT_ORDER = ("MILLENNIA", "CENTURIES", "DECADES", "YEARS", "MONTHS", "WEEKS", "DAYS",
              "HALF_DAYS", "HOURS", "MINUTES", "SECONDS", "MILLIS", "MICROS", "NANOS")


class DurationError(ValueError):
    pass


def parse_duration(text: str | None) -> dict[str, int]:
    """``"<n> <unit>, <n> <unit>"`` → {unit: n}.  Units ignore case; blank
    text is empty; a bad number, missing or unknown unit, a duplicate unit or
    a negative value is an error."""
    if text is None or not str(text).strip():
        return {}
    out: dict[str, int] = {}
    for piece in str(text).split(","):
        kv = piece.strip().split(" ", 1)
        if len(kv) < 2:
            raise DurationError(
                f"Invalid duration '{text}'. Expected format is '<VALUE> <UNIT>, ...', e.g. '1 days, 2 hours'")
        unit = kv[1].strip().upper()
        if unit not in FIXED_UNITS and unit not in CALENDAR_UNITS:
            raise DurationError(f"Invalid duration unit '{kv[1]}' in '{text}'")
        try:
            value = int(kv[0].strip())
        except ValueError:
            raise DurationError(f"Invalid duration value '{kv[0]}' in '{text}'") from None
        if unit in out:
            raise DurationError(f"Duration '{text}' has duplicate unit '{unit}'")
        if value < 0:
            raise DurationError(f"Duration values must be 0 or greater: '{text}'")
        out[unit] = value
    return out


def _as_datetime(v) -> dt.datetime:
    if isinstance(v, dt.datetime):
        d = v
    elif isinstance(v, dt.date):
        d = dt.datetime(v.year, v.month, v.day)
    elif isinstance(v, (int, float)):
        d = dt.datetime.fromtimestamp(v / 1000.0, tz=dt.timezone.utc)
    else:
        s = str(v).strip().replace("Z", "+00:00")
        d = dt.datetime.fromisoformat(s)
    if d.tzinfo is not None:
        d = d.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return d


def _minus(t: dt.datetime, unit: str, n: int) -> dt.datetime:
    if unit in CALENDAR_UNITS:
        months = CALENDAR_UNITS[unit] * n
        day = add_months(t.date(), -months)
        return dt.datetime.combine(day, t.time())
    if unit == "NANOS":
        # fields hold microseconds: "not before t - n ns" begins at the next whole one
        return t - dt.timedelta(microseconds=n // 1000)
    return t - FIXED_UNITS[unit] * n


def range_bounds(as_of, duration: dict[str, int] | str | None,
                 offset: dict[str, int] | str | None) -> tuple[dt.datetime | None, dt.datetime | None]:
    """F-10: ``end = as_of - offset``, ``start = end - duration``.

    Units are subtracted largest first (months before days), so a result does
    not depend on how the units were listed.  No duration gives only the upper
    bound; nothing to subtract gives no filter (both None).
    """
    dur = parse_duration(duration) if isinstance(duration, str) or duration is None else dict(duration)
    off = parse_duration(offset) if isinstance(offset, str) or offset is None else dict(offset)
    has_duration, has_offset = any(dur.values()), any(off.values())
    if not has_duration and not has_offset:
        return None, None
    start_time = _as_datetime(as_of)
    end = start_time
    for u in UNIT_ORDER:
        if u in off:
            end = _minus(end, u, off[u])
    start = end
    for u in UNIT_ORDER:
        if u in dur:
            start = _minus(start, u, dur[u])
    return (start if has_duration else None), end


def interval_condition(c: Column, since=None, until=None) -> Column | None:
    """F-09: ``since <= c < until``; either side optional."""
    cond = None
    if since is not None:
        cond = c >= F.lit(_as_datetime(since))
    if until is not None:
        u = c < F.lit(_as_datetime(until))
        cond = u if cond is None else cond & u
    return cond


def modified_filter(obj, since=None, until=None, as_of=None, duration=None,
                    offset=None) -> Column | None:
    """The object-scan time filter: the interval wins over the range.  Options
    that can't be read are an error, and so is a duration or offset without
    the time (``as_of``) it counts back from."""
    failures = validate_scan_options(since, until, duration, offset)
    if failures:
        raise DurationError("; ".join(failures))
    if since is None and until is None and as_of is None:
        if duration or offset:
            raise DurationError("A duration or offset needs as_of, the time it counts back from")
        return None
    if not obj.modified_field:
        raise ValueError(f"Object '{obj.name}' has no modified-time field")
    c = F.col(obj.modified_field)
    if since is not None or until is not None:
        return interval_condition(c, since, until)
    lo, hi = range_bounds(as_of, duration, offset)
    return interval_condition(c, lo, hi)


def validate_scan_options(since=None, until=None, duration=None, offset=None,
                          operation: str | None = None) -> list[str]:
    """V-06: every problem with the time-filter and operation options."""
    failures = []
    for label, v in (("since", since), ("until", until)):
        if v is not None and not isinstance(v, (dt.date, dt.datetime)):
            try:
                _as_datetime(v)
            except ValueError:
                failures.append(f"Invalid datetime for '{label}': '{v}'")
    for label, v in (("duration", duration), ("offset", offset)):
        if isinstance(v, str) or v is None:
            try:
                parse_duration(v)
            except DurationError as e:
                failures.append(f"Invalid {label}: {e}")
    if operation is not None and operation not in ("query", "queryAll"):
        failures.append(f"Invalid query operation '{operation}'; expected query or queryAll")
    return failures
