"""All rows but the first n of an order (O-04), as one lazy plan.

The n-th row of the order, its keys alone, is a bounded top-n (a scalar
sub-query).  Rows behind it in the order pass a filter; only they are sorted, by
range partitions.  The order is made total by a hash of the whole row, so rows that equal the
n-th one are the same row: one aggregate counts how many of them lie behind the cut.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..naming import quote

#: rows that a task keeps to find the n-th one, at most
MOST_SKIPPED = 1_000_000


def _hashable(f: T.StructField) -> Column:
    c = F.col(quote(f.name))
    return F.array_sort(F.map_entries(c)) if isinstance(f.dataType, T.MapType) else c


def _after(a: Column, b: Column, descending: bool, nulls: str) -> Column:
    """Whether ``a`` comes behind ``b`` (never null)."""
    value = F.coalesce((a < b) if descending else (a > b), F.lit(False))
    other = (b.isNull() & a.isNotNull()) if nulls == "first" else (a.isNull() & b.isNotNull())
    return value | other


def skip_rows(df: DataFrame, keys: list[tuple[str, bool, str]], n: int) -> DataFrame:
    """``df`` in the order of ``keys`` (column, descending, nulls first or
    last) without its first ``n`` rows (1 to ``MOST_SKIPPED``)."""
    if not 1 <= n <= MOST_SKIPPED:
        raise ValueError(f"between 1 and {MOST_SKIPPED} rows can be skipped")
    rows = df.withColumn("__h", F.xxhash64(*[_hashable(f) for f in df.schema.fields]))
    keys = [*keys, ("__h", False, "first")]

    def order() -> list[Column]:
        out = []
        for name, descending, nulls in keys:
            c = F.col(quote(name))
            out.append((c.desc_nulls_first() if nulls == "first" else c.desc_nulls_last()) if descending
                       else (c.asc_nulls_first() if nulls == "first" else c.asc_nulls_last()))
        return out
    last = rows.select(*[F.col(quote(k)) for k, _, _ in keys]).orderBy(*order()).offset(n - 1).limit(1) \
        .select(F.struct(*[F.col(quote(k)).alias(f"k{i}") for i, (k, _, _) in enumerate(keys)])).scalar()
    same = reduce(lambda x, y: x & y, [F.col(quote(k)).eqNullSafe(last[f"k{i}"]) for i, (k, _, _) in enumerate(keys)])
    behind, equal = F.lit(False), F.lit(True)
    for i, (name, descending, nulls) in enumerate(keys):
        a, b = F.col(quote(name)), last[f"k{i}"]
        behind = behind | (equal & _after(a, b, descending, nulls))
        equal = equal & a.eqNullSafe(b)
    there = last.isNotNull()        # null: there are fewer rows
    count = rows.agg(F.count_if(~behind & ~same).alias("before"), F.count_if(same).alias("equal"),
                     F.first(F.when(same, F.struct(*[F.col(quote(c)) for c in rows.columns])), ignorenulls=True).alias("row"))
    kept = F.col("equal") - (F.lit(n) - F.col("before"))
    again = count.where(there & (kept > 0)).select(F.explode(F.sequence(F.lit(1).cast("long"), kept)), "row").select("row.*")
    return rows.where(there & behind).unionByName(again).orderBy(*order()).drop("__h")
