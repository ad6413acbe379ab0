"""Aggregate functions with the result-type rules of A-01..A-08."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .expr import Expr, as_item


class AggExpr(Expr):
    kind = "agg"

    def __init__(self, fname: str, arg: Expr | None, build):
        self.fname = fname
        self.arg = arg
        super().__init__(f"{fname}({arg.key if arg is not None else ''})",
                         lambda r: r.agg(self), (arg,) if arg is not None else (),
                         is_function=True)
        self._agg_build = build

    def agg_column(self, r) -> Column:
        """The aggregate over the pre-aggregation rows."""
        return self._agg_build(r)


def _typed_sum(r, arg: Expr) -> Column:
    c = arg.to_column(r)
    dt = r.data_type(c)
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.sum(c).cast("long")
    if isinstance(dt, (T.DoubleType, T.FloatType)):
        return F.sum(c).cast("double")
    if isinstance(dt, T.DecimalType):
        return F.sum(c)
    raise TypeError(f"SUM is not defined for field '{arg.key}' of type {dt.simpleString()}")


def min_(f) -> AggExpr:
    """A-01: same type as the field."""
    a = as_item(f)
    return AggExpr("MIN", a, lambda r: F.min(a.to_column(r)))


def max_(f) -> AggExpr:
    """A-02: same type as the field."""
    a = as_item(f)
    return AggExpr("MAX", a, lambda r: F.max(a.to_column(r)))


def sum_(f) -> AggExpr:
    """A-03: int/long → long, double → double; other types are rejected."""
    a = as_item(f)
    return AggExpr("SUM", a, lambda r: _typed_sum(r, a))


def avg_(f) -> AggExpr:
    """A-04: double."""
    a = as_item(f)
    return AggExpr("AVG", a, lambda r: F.avg(a.to_column(r)).cast("double"))


def count_(f=None) -> AggExpr:
    """A-05 ``COUNT()`` (rows) and A-06 ``COUNT(field)`` (non-null values): long."""
    if f is None:
        return AggExpr("COUNT", None, lambda r: F.count(F.lit(1)).cast("long"))
    a = as_item(f)
    return AggExpr("COUNT", a, lambda r: F.count(a.to_column(r)).cast("long"))


def count_distinct_(f) -> AggExpr:
    """A-07: long."""
    a = as_item(f)
    return AggExpr("COUNT_DISTINCT", a, lambda r: F.count_distinct(a.to_column(r)).cast("long"))


class GroupingExpr(Expr):
    """A-08: 1 when the row is a subtotal over the field, else 0 (int)."""

    kind = "agg"

    def __init__(self, arg: Expr):
        self.arg = arg
        super().__init__(f"GROUPING({arg.key})", lambda r: r.grouping(self), (arg,),
                         is_function=True)


def grouping_(f) -> GroupingExpr:
    return GroupingExpr(as_item(f))
