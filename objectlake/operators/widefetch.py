"""Key-first wide fetch (S-11): filter on a narrow projection, then fetch
the full rows by key.  The key list is never collected: it is the right side
of a left-semi join, which Spark broadcasts when small and shuffles
(with AQE skew splitting) when large.

On Parquet a plain filter already reads only the columns it needs, so the
two-pass form pays off when the filter is costly to evaluate next to wide
rows (joins through references, sub-queries) or when the key set is reused;
the result always equals the direct filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..naming import quote


def wide_fetch(query, key: str = "Id", fields=None) -> DataFrame:
    """Rows of the query's object selected by ``query`` (run with only ``key``
    selected), with every field (or ``fields``) of the object."""
    cat = query.catalog
    narrow = query._copy()
    narrow._select = []
    narrow = narrow.select(key)
    ids = narrow.to_df()
    keys = ids.select(F.col(quote(ids.columns[0])).alias("__key"))
    table = cat.table(query.obj_name, include_deleted=query._include_deleted)
    cols = list(fields) if fields else [c for c in cat.fields(query.obj_name)]
    real_key = cat.field_name(query.obj_name, key)
    return table.join(keys, F.col(quote(real_key)) == F.col("__key"), "left_semi").select(
        *[F.col(quote(c)) for c in cols])
