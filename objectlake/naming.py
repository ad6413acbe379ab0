"""Name rules for output columns (P-06) and dotted paths (P-05)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Allowed first character and allowed characters of a name.
_START = re.compile(r"^[A-Za-z_]")
_BAD = re.compile(r"[^A-Za-z0-9_]")


def normalize_name(name: str) -> str:
    """Prefix ``A`` unless the name starts with a letter or ``_``, then map
    every character outside ``[A-Za-z0-9_]`` to ``_``."""
    if not _START.search(name):
        name = "A" + name
    return _BAD.sub("_", name)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename every column of ``df`` by :func:`normalize_name`."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def normalize_name_col(col: Column) -> Column:
    """The same rule as a Spark expression, for names held in data."""
    prefixed = F.when(col.rlike("^[A-Za-z_]"), col).otherwise(F.concat(F.lit("A"), col))
    return F.regexp_replace(prefixed, "[^A-Za-z0-9_]", "_")


def quote(name: str) -> str:
    """Backtick-quote a column name that may hold dots."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quote(name))
