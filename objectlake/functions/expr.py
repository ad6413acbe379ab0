"""Deferred column expressions over object field paths.

``fld("Account.Territory.Name")`` names a field through N:1 references.  The
query builder collects the paths of every expression, adds one left join per
distinct path prefix, and only then turns each expression into a Spark
``Column``.  Everything an expression finally becomes is a built-in Spark
expression, so filters push down and stay inside whole-stage codegen.
"""

from __future__ import annotations

import copy
import datetime as _dt
import re
from collections.abc import Callable, Iterable, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


_ZONED = re.compile(r"[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:?[0-9]{2})$")


class Expr:
    """A column expression that is resolved against a query's joined rows."""

    kind = "value"          # value | agg | subquery | sort

    def __init__(self, key: str, build: Callable[[Any], Column],
                 children: Sequence[Expr] = (), name: str | None = None,
                 is_function: bool = False):
        self.key = key
        self._build = build
        self.children = tuple(children)
        self.name = name                    # alias given by the user
        self.is_function = is_function      # a named function (needs alias, C-*)

    # -- resolution ------------------------------------------------------
    def to_column(self, r) -> Column:
        hit = r.lookup(self)
        if hit is not None:
            return hit
        return self._build(r)

    def walk(self):
        yield self
        for c in self.children:
            yield from c.walk()

    @property
    def paths(self) -> set[str]:
        return {e.path for e in self.walk() if isinstance(e, FieldRef)}

    @property
    def has_agg(self) -> bool:
        return any(e.kind == "agg" for e in self.walk())

    def default_name(self) -> str | None:
        return None

    # -- naming ----------------------------------------------------------
    def alias(self, name: str) -> Expr:
        e = copy.copy(self)
        e.name = name
        return e

    def __repr__(self) -> str:
        return f"Expr({self.key}{' AS ' + self.name if self.name else ''})"

    # -- operators (F-01, F-07, F-08) ------------------------------------
    op: str | None = None    # operator of a binary node (AND splits a WHERE)

    def _bin(self, other, sym: str, fn) -> Expr:
        o = as_expr(other)
        e = Expr(f"({self.key} {sym} {o.key})",
                 lambda r: fn(self.to_column(r), o.to_column(r)), (self, o))
        e.op = sym
        return e

    def _cmp(self, other, sym: str, fn) -> Expr:
        """Comparison hook; range functions rewrite it on their argument.
        ISO text with Z or an offset, next to a date or time, means that instant."""
        if isinstance(other, str) and _ZONED.match(other.strip()):
            from pyspark.sql import types as T

            from .timefilter import _as_datetime

            def build(r):
                mine = self.to_column(r)
                kind = r.data_type(mine)
                if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
                    at = F.lit(_as_datetime(other).isoformat(sep=" "))
                    return fn(mine, at.cast("date" if isinstance(kind, T.DateType) else kind))
                return fn(mine, F.lit(other))
            e = Expr(f"({self.key} {sym} {other!r})", build, (self,))
            e.op = sym
            return e
        return self._bin(other, sym, fn)

    def __eq__(self, other):  # type: ignore[override]
        if other is None:       # F-04: ``= NULL``
            return self.is_null()
        return self._cmp(other, "=", lambda a, b: a == b)

    def __ne__(self, other):  # type: ignore[override]
        if other is None:       # F-04: ``!= NULL``
            return self.is_not_null()
        return self._cmp(other, "!=", lambda a, b: a != b)

    def __lt__(self, other):
        return self._cmp(other, "<", lambda a, b: a < b)

    def __le__(self, other):
        return self._cmp(other, "<=", lambda a, b: a <= b)

    def __gt__(self, other):
        return self._cmp(other, ">", lambda a, b: a > b)

    def __ge__(self, other):
        return self._cmp(other, ">=", lambda a, b: a >= b)

    def __and__(self, other):
        return self._bin(other, "AND", lambda a, b: a & b)

    def __or__(self, other):
        return self._bin(other, "OR", lambda a, b: a | b)

    def __rand__(self, other):
        return as_expr(other) & self

    def __ror__(self, other):
        return as_expr(other) | self

    def __invert__(self):
        return Expr(f"(NOT {self.key})", lambda r: ~self.to_column(r), (self,))

    def __add__(self, other):
        return self._bin(other, "+", lambda a, b: a + b)

    def __sub__(self, other):
        return self._bin(other, "-", lambda a, b: a - b)

    def __mul__(self, other):
        return self._bin(other, "*", lambda a, b: a * b)

    def __truediv__(self, other):
        return self._bin(other, "/", lambda a, b: a / b)

    __hash__ = None  # type: ignore[assignment]

    def __bool__(self):
        raise TypeError("An object expression has no truth value: combine conditions with "
                        "& (and), | (or) and ~ (not), and put comparisons in parentheses")

    # -- predicates ------------------------------------------------------
    def is_null(self) -> Expr:
        return Expr(f"({self.key} = NULL)", lambda r: self.to_column(r).isNull(), (self,))

    def is_not_null(self) -> Expr:
        return Expr(f"({self.key} != NULL)", lambda r: self.to_column(r).isNotNull(), (self,))

    def like(self, pattern: str, ci: bool = False) -> Expr:
        """F-02: ``%`` and ``_`` wildcards; case-sensitive unless ``ci``."""
        def build(r):
            c = self.to_column(r)
            return c.ilike(pattern) if ci else c.like(pattern)
        return Expr(f"({self.key} LIKE {pattern!r}{' CI' if ci else ''})", build, (self,))

    def isin(self, values) -> Expr:
        """F-03 on a literal list, J-04 on an ``ObjectQuery`` (semi-join)."""
        if _is_query(values):
            return SubqueryIn(self, values, negate=False)
        vals = list(values)
        return Expr(f"({self.key} IN {vals!r})",
                    lambda r: self.to_column(r).isin(vals), (self,))

    def notin(self, values, null_safe: bool = False) -> Expr:
        """F-03 ``NOT IN`` list, J-05 on an ``ObjectQuery``: the SQL null rule
        by default; ``null_safe=True`` keeps rows whose value is not among the
        non-null values of the query (NOT EXISTS)."""
        if _is_query(values):
            return SubqueryIn(self, values, negate=True, null_safe=null_safe)
        vals = list(values)
        return Expr(f"({self.key} NOT IN {vals!r})",
                    lambda r: ~self.to_column(r).isin(vals), (self,))

    def includes(self, sets: Iterable[str], sep: str = ";") -> Expr:
        """F-05: the multi-select value holds every value of at least one of
        ``sets`` (values inside one set are joined by ``;``)."""
        groups = [[v for v in s.split(sep)] for s in sets]

        def build(r):
            parts = F.split(self.to_column(r), _sep_regex(sep))
            tests = [F.size(F.array_except(F.array(*[F.lit(v) for v in g]), parts)) == 0
                     for g in groups]
            out = tests[0]
            for t in tests[1:]:
                out = out | t
            return F.when(self.to_column(r).isNotNull(), out)
        return Expr(f"({self.key} INCLUDES {list(sets)!r})", build, (self,))

    def excludes(self, sets: Iterable[str], sep: str = ";") -> Expr:
        """F-06: negation of :meth:`includes`."""
        inc = self.includes(sets, sep)
        return Expr(f"({self.key} EXCLUDES {list(sets)!r})",
                    lambda r: ~inc.to_column(r), (self,))

    def within(self, literal: str, as_of, op: str = "=", week_start: int = 1,
               fy_start: int = 1, tz: str | None = None) -> Expr:
        """F-13: compare with a relative date literal such as ``LAST_N_DAYS:30``.

        ``tz`` names the zone whose calendar days count for a datetime field
        (stored in UTC): the day bounds become the UTC instants of local
        midnight, so the test stays a plain range on the field.  Date fields
        ignore ``tz``."""
        from pyspark.sql import types as T

        from .reldates import compare_range, local_midnight_utc, relative_range

        lo, hi = relative_range(literal, as_of, week_start=week_start, fy_start=fy_start)

        def build(r):
            c = self.to_column(r)
            if tz and not isinstance(r.data_type(c), T.DateType):
                return compare_range(c, local_midnight_utc(lo, tz), local_midnight_utc(hi, tz), op)
            return compare_range(c, lo, hi, op)
        return Expr(f"({self.key} {op} {literal}{' @' + tz if tz else ''})", build, (self,))

    # -- ordering (O-01, O-02) -------------------------------------------
    def asc(self, nulls: str = "first") -> SortKey:
        return SortKey(self, False, nulls)

    def desc(self, nulls: str = "first") -> SortKey:
        return SortKey(self, True, nulls)


class FieldRef(Expr):
    """A field reached from the query's object, possibly through references."""

    def __init__(self, path: str):
        self.path = path
        super().__init__(path, lambda r: r.field(path))

    def default_name(self) -> str:
        return self.path


class SortKey:
    kind = "sort"

    def __init__(self, expr: Expr, descending: bool, nulls: str = "first"):
        if nulls not in ("first", "last"):
            raise ValueError("nulls must be 'first' or 'last'")
        self.expr, self.descending, self.nulls = expr, descending, nulls

    def to_column(self, r) -> Column:
        return self.apply(self.expr.to_column(r))

    def apply(self, c: Column) -> Column:
        """``c`` as a sort key with this key's direction and null placement."""
        if self.descending:
            return c.desc_nulls_first() if self.nulls == "first" else c.desc_nulls_last()
        return c.asc_nulls_first() if self.nulls == "first" else c.asc_nulls_last()


class SubqueryIn(Expr):
    """``x IN (query)`` / ``x NOT IN (query)``; planned as a semi / anti join."""

    kind = "subquery"

    def __init__(self, expr: Expr, query, negate: bool, null_safe: bool = False):
        self.expr, self.query, self.negate, self.null_safe = expr, query, negate, null_safe
        self.planned: Column | None = None

        def build(r):
            # under OR or NOT of a WHERE: the column of the flag join planned for it
            if self.planned is not None:
                return self.planned
            sub = query.to_df()
            c = self.expr.to_column(r).isin(sub.select(sub.columns[0]))
            return ~c if negate else c
        super().__init__(f"({expr.key} {'NOT IN' if negate else 'IN'} <query {id(query)}>)",
                         build, (expr,))


def _is_query(v) -> bool:
    return hasattr(v, "to_df") and hasattr(v, "obj_name")


def _sep_regex(sep: str) -> str:
    import re
    return re.escape(sep)


def fld(path: str) -> FieldRef:
    """A field of the query object; dots follow N:1 references (J-01, P-05)."""
    return FieldRef(path)


def param(name: str) -> Expr:
    """F-15: a named placeholder, bound with ``ObjectQuery.bind(name=value)``."""
    def build(r):
        if name not in r.params:
            raise KeyError(f"Parameter '${{{name}}}' is not bound")
        return F.lit(r.params[name])
    return Expr(f"${{{name}}}", build)


def lit(value) -> Expr:
    """F-12/F-14 literals: str, int, float, bool, date, datetime (or ISO text)."""
    if isinstance(value, Expr):
        return value
    return Expr(repr(value), lambda r: F.lit(value))


def as_expr(v) -> Expr:
    if isinstance(v, Expr):
        return v
    if isinstance(v, str):
        return lit(v)
    if isinstance(v, (int, float, bool, _dt.date, _dt.datetime)) or v is None:
        return lit(v)
    if isinstance(v, Column):
        return Expr(f"<column {id(v)}>", lambda r: v)
    raise TypeError(f"Cannot use {type(v).__name__} in an object expression")


def as_item(v) -> Expr:
    """Selection items: a string is a field path, anything else an expression."""
    if isinstance(v, str):
        if v.strip() == "*" or v.strip().endswith(".*"):
            raise ValueError("'*' is not allowed in a field list; name the fields")
        return fld(v)
    return as_expr(v)


def col_expr(fn: Callable[[Column], Column], arg: Expr, name: str) -> Expr:
    """Wrap a one-argument Column function as a named function expression."""
    arg = as_item(arg)
    return Expr(f"{name}({arg.key})", lambda r: fn(arg.to_column(r)), (arg,), is_function=True)


def func(name: str, arg) -> Expr:
    """C-15: any other function name over one field, looked up in the catalog
    (``Catalog.register_function``); unknown names pass the field through."""
    arg = as_item(arg)

    def build(r):
        fn = r.catalog.function(name)
        c = arg.to_column(r)
        return fn(c) if fn is not None else c
    return Expr(f"{name.upper()}({arg.key})", build, (arg,), is_function=True)


def and_(*conds) -> Expr:
    out = as_expr(conds[0])
    for c in conds[1:]:
        out = out & c
    return out


def or_(*conds) -> Expr:
    out = as_expr(conds[0])
    for c in conds[1:]:
        out = out | c
    return out


def not_(cond) -> Expr:
    return ~as_expr(cond)


def conjuncts(e: Expr) -> list[Expr]:
    """Split a condition on its top-level ANDs."""
    if e.op == "AND" and e.kind == "value":
        return conjuncts(e.children[0]) + conjuncts(e.children[1])
    return [e]
